"""spokenlake.functions"""
