"""spokenlake.plans"""
