"""Regional coverage analytics as Spark jobs.

The package holds DataFrame functions only; Catalyst plans them.  ``functions``
works on columns, ``operators`` on frames, ``sources`` reads and writes,
``plans`` puts them together into cleaning, loading, marts and reports, and
``streaming`` runs the incremental jobs.
"""

__version__ = "0.1.0"
