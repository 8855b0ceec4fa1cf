"""examlytics.plans"""
