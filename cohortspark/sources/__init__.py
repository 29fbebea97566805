"""cohortspark.sources"""
