"""examlytics.streaming"""
