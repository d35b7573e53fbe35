"""loomcast.streaming"""
