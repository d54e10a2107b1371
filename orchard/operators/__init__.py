"""orchard.operators"""
