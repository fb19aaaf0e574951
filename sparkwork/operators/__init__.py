"""sparkwork.operators"""
