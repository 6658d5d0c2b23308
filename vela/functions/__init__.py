"""Column-expression helpers (JVM-side, inside whole-stage codegen)."""
from vela.functions.columns import *  # noqa: F401,F403
