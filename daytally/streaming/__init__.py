"""The incremental load as a stream over the landing folder."""

from daytally.streaming.landing import load_landed

__all__ = ["load_landed"]
