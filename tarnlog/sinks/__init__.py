"""tarnlog.sinks"""
