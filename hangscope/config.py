"""Job parameters.

The defaults mirror the original job's configuration.  Network, object-store
and debug-print switches have no counterpart here: Spark reads and writes any
path it is given.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone


# Fixed values that must equal the original job's for identical results.
UNSYMBOLICATED = "<unsymbolicated>"
UNKNOWN_LIB = "unknown"
SYMBOL_TRUNCATE_LENGTH = 200
MAX_STACK_FRAMES = 300          # stacks must have 1..299 raw frames
HISTOGRAM_BUCKETS = 8
FORCE_PAINT_THREAD = "Gecko_Child_ForcePaint"
ALL_HANGS = "All Hangs"
UNKNOWN_COMPONENT = "unknown_component"
UNCATEGORIZED = "uncategorized"
OTHER_FRAME = "(other)"
ROOT_FRAME = "(root)"
DOC_TYPE_CUTOVER = "20180315"   # storage doc type is OTHER up to this build date
ANNOTATION_PENDING_INPUT = "PendingInput"
ANNOTATION_CPU_HIGH = "ExternalCPUHigh"
ANNOTATION_FORCE_PAINT = "PaintWhileInterruptingJS"
CRASH_RUNNABLE = "dummy_runnable"
CRASH_USAGE_MS = 86400


def days_ago(n: int) -> str:
    return (datetime.now(timezone.utc).date() - timedelta(days=n)).strftime("%Y%m%d")


@dataclass(frozen=True)
class HangConfig:
    # the original's window, nine days ago to yesterday; None for both is all dates
    start_date: str | None = field(default_factory=lambda: days_ago(9))   # YYYYMMDD, inclusive
    end_date: str | None = field(default_factory=lambda: days_ago(1))     # YYYYMMDD, inclusive for scans
    channel: str = "nightly"
    sample_size: float = 0.5             # share of pings read
    hang_lower_bound: int = 128
    hang_upper_bound: int = 16000
    stack_acceptance_threshold: float = 0.01
    use_minimal_sample_table: bool = False
    post_sample_size: float = 1.0
    exclude_modules: bool = False
    split_threads_in_out_file: bool = False
    # JSON documents per thread, as the original wrote them (one for a small
    # thread, pieces of operators.profile.PIECE_ROWS entries for a large one)
    one_document_per_thread: bool = False
    profile_chunk_rows: int = 50_000     # entries per chunk of the default output
    append_date: bool = False
    use_crashes: bool = False
    hang_profile_in_filename: str = "hang_profile_128_16000"
    hang_profile_out_filename: str | None = None
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    run_date: str = field(default_factory=lambda: days_ago(0))   # in file names with append_date
    failfast: bool = False               # a symbol line that can't be parsed fails the job
    # width (as a power of two) of the address ranges the as-of symbol join
    # is partitioned by; bounds the rows any single task sorts
    symbol_bucket_bits: int = 16

    def with_(self, **kw) -> "HangConfig":
        return replace(self, **kw)

    @property
    def out_name(self) -> str:
        return self.hang_profile_out_filename or self.hang_profile_in_filename


# every date and every ping: what the registered queries read
DEFAULT = HangConfig(start_date=None, end_date=None, sample_size=1.0, run_id="default")
