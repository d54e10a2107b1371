"""orchard.functions"""
