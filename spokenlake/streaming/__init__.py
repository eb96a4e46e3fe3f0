"""spokenlake.streaming"""
