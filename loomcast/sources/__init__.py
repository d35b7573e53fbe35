"""loomcast.sources"""
