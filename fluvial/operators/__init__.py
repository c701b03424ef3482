"""fluvial.operators"""
