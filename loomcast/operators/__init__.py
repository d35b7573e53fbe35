"""loomcast.operators"""
