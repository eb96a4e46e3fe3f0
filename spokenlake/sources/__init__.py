"""spokenlake.sources"""
