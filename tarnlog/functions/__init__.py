"""tarnlog.functions"""
