"""sparkwork.streaming"""
