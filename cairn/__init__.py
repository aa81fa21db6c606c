"""Cairn: a PySpark-native engine for annotated entity tables and the similarity data that links them."""

from cairn.session import get_session

__all__ = ["get_session"]
