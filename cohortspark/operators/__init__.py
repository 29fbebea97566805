"""cohortspark.operators"""
