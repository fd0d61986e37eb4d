"""tessera.plans"""
