"""tabloom: tabular preparation, profiling, training and evaluation as Spark jobs.

Stateful preparation comes as fit/apply pairs: ``fit_*`` reads a training
frame and returns small parameters; ``apply_*`` is a map-side projection that
works on any frame (batch or streaming).
"""

__version__ = "0.1.0"
