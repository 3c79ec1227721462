"""The jobs: each takes DataFrames of ``tallywing.sources`` and gives its result as one."""
