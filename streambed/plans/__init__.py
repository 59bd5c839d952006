"""Whole results: the gold marts, the fact tables and the jobs that build them."""
