"""voxloom.streaming"""
