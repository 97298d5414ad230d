"""courtload — sports-workload analytics as lazy Spark DataFrame operators.

Every public operator takes DataFrames plus explicit column / threshold
parameters and returns a lazy DataFrame: no actions, no collects.  The
batch job (``plans.batch``) and the streaming job (``streaming``) reuse
the same operators.
"""

__version__ = "0.1.0"
