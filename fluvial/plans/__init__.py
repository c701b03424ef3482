"""fluvial.plans"""
