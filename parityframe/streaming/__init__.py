"""Left without operators: the workload this library serves is batch only.

The row-wise steps of :mod:`parityframe.operators.refine` and
:mod:`parityframe.functions.labels` keep no state, so they also accept a streaming DataFrame.
"""
