"""tarnlog.plans"""
