"""sparkwork.sources"""
