"""winnow.functions"""
