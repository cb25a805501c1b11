"""Registered queries (``catalog``), their SQL twins (``oracle``) and the
composed load jobs (``jobs``)."""
