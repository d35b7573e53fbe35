"""loomcast.plans"""
