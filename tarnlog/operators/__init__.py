"""tarnlog.operators"""
