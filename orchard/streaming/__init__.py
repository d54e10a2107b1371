"""orchard.streaming"""
