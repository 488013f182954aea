"""tidemark.sinks"""
