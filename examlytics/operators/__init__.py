"""examlytics.operators"""
