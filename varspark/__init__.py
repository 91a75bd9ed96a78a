"""Annotation of variant tables on Spark: every public function is DataFrame -> DataFrame."""
