"""spokenlake.operators"""
