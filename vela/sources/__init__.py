"""Sources and sinks: delimited text, Parquet tables, model hand-off."""
from vela.sources.io import *  # noqa: F401,F403
