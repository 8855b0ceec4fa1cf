"""examlytics.sources"""
