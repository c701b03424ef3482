"""fluvial.sources"""
