"""orchard.plans"""
