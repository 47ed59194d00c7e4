"""tidemark: a lakehouse analytics engine expressed on the public PySpark APIs."""

from tidemark.session import build_session

__all__ = ["build_session"]
