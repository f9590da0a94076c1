"""hangscope: application-hang telemetry analytics as Spark DataFrame jobs.

Pings carrying hangs (a call stack plus a duration) are exploded, their
module/offset frames are resolved to function names by an as-of lookup in
symbol tables, and the result is normalised by usage hours per build date.
Outputs are hang rates per stack, duration histograms by component / thread /
category, and per-thread stack profiles with rare branches folded into
``(other)``.  Every operator is a ``DataFrame -> DataFrame`` function.
"""

from hangscope.config import HangConfig

__all__ = ["HangConfig"]
