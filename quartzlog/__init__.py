"""A transactional table log on Spark."""

__all__ = ["TableLog"]


def __getattr__(name):  # the entry point loads on first use: workers that only run functions of a subpackage don't need it
    if name == "TableLog":
        from .table import TableLog

        return TableLog
    raise AttributeError(name)
