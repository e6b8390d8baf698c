"""tarnlog.streaming"""
