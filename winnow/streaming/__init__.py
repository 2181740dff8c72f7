"""winnow.streaming"""
