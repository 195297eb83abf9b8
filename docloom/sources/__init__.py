"""docloom.sources"""
