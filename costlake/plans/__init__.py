"""Compositions: star schema, marts, serving queries, costs, pipelines."""
