"""loomcast.functions"""
