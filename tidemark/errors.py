"""Errors that name the stream, schema or column at fault."""

from __future__ import annotations

from pyspark.errors import AnalysisException


class UnknownStream(LookupError):
    """A requested schema or stream is not in the catalog."""


class NoData(FileNotFoundError):
    """A path is missing, or holds no Parquet data."""


class SchemaDrift(ValueError):
    """Files or snapshots that should share a schema do not."""


class CursorRefused(ValueError):
    """A column cannot serve as the cursor of an incremental read."""


class SyncFailed(RuntimeError):
    """Some streams of a sync failed; the others were landed."""

    def __init__(self, failures: dict[str, str]):
        self.failures = failures
        detail = "; ".join(f"{name}: {why}" for name, why in sorted(failures.items()))
        super().__init__(f"{len(failures)} stream(s) failed: {detail}")


def condition(error: Exception) -> str | None:
    """Spark's error condition of an analysis error, else None."""
    return error.getCondition() if isinstance(error, AnalysisException) else None


def first_line(error: Exception) -> str:
    """The telling line of an error, without the JVM stack."""
    lines = str(error).strip().splitlines() or [type(error).__name__]
    if lines[0].startswith("An error occurred while calling") and lines[1:]:
        return lines[1].lstrip(": ")  # the JVM's own message
    return lines[0]
