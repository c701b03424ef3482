"""fluvial.streaming"""
