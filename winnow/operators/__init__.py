"""winnow.operators"""
