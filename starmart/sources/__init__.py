"""Readers and writers: the only place, next to ``plans``, where jobs are started."""
