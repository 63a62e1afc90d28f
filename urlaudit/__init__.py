"""Spark-native audit of a URL register: select, resolve, record, pace and report."""

from urlaudit.config import AuditConfig

__all__ = ["AuditConfig"]
