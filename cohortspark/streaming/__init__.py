"""cohortspark.streaming"""
