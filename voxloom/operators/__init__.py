"""voxloom.operators"""
