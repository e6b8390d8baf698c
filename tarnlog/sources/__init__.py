"""tarnlog.sources"""
