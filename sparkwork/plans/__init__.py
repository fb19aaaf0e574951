"""sparkwork.plans"""
