"""Tests of the operators on text."""
