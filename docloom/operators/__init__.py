"""docloom.operators"""
