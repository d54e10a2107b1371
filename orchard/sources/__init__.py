"""orchard.sources"""
