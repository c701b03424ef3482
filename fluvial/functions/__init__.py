"""fluvial.functions"""
