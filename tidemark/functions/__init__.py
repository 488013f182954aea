"""tidemark.functions"""
