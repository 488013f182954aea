"""tidemark.operators"""
