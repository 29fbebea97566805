"""cohortspark.plans"""
