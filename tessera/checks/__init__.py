"""tessera.checks"""
