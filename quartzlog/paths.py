"""Names of log files, and paths of data files as the log writes them."""

from __future__ import annotations

import re
from urllib.parse import unquote

from .errors import IllegalArgument

#: Fixed values of the format.
LOG_DIR = "_delta_log"
HINT = "_last_checkpoint"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
COMMIT = re.compile(r"\d+\.json")
CHECKPOINT = re.compile(r"\d+\.checkpoint(\.\d+\.\d+)?\.parquet")
SCHEME = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*:")
LITERAL = frozenset("/_-!.~'()*,;:$&+=@")


def commit_name(version: int) -> str:
    return f"{version:020d}.json"


def checkpoint_name(version: int, part: int | None = None, parts: int | None = None) -> str:
    return f"{version:020d}.checkpoint.parquet" if parts is None else f"{version:020d}.checkpoint.{part:010d}.{parts:010d}.parquet"


def checkpoint_names(version: int, parts: int | None = None) -> list[str]:
    return [checkpoint_name(version)] if parts is None else [checkpoint_name(version, i, parts) for i in range(1, parts + 1)]


def base_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def is_commit(path: str) -> bool:
    return bool(COMMIT.search(base_name(path)))


def is_checkpoint(path: str) -> bool:
    return bool(CHECKPOINT.search(base_name(path)))


def version_of(path: str) -> int:
    return int(base_name(path).split(".")[0])


def parts_of(path: str) -> int | None:
    pieces = base_name(path).split(".")
    return int(pieces[3]) if len(pieces) == 5 else None


def part_of(path: str) -> int | None:
    pieces = base_name(path).split(".")
    return int(pieces[2]) if len(pieces) == 5 else None


def scheme_of(path: str) -> str:
    m = SCHEME.match(path)
    return m[0][:-1] if m else "file"


def canonical(path: str) -> str:
    """`file:/x`, `file:///x` and `/x` are one path; relative paths and object stores stay as they are."""
    if path.startswith("file:"):
        return "file:///" + path[5:].lstrip("/")
    return "file://" + path if path.startswith("/") else path


def canonical_column(path):
    from pyspark.sql import functions as F

    return F.when(path.rlike("^file:"), F.concat(F.lit("file:///"), F.regexp_replace(path, "^file:/*", ""))).when(path.startswith("/"), F.concat(F.lit("file://"), path)).otherwise(path)


def relative_to(base: str, path: str) -> str:
    """As a commit writes it: relative under the table's folder, else `file://` and absolute; object stores stay."""
    if not SCHEME.match(path) and not path.startswith("/"):
        return path
    if scheme_of(path) != "file":
        return path
    root, own = canonical(base).rstrip("/") + "/", canonical(path)
    return own[len(root) :] if own.startswith(root) else own


def join(base: str, name: str) -> str:
    """A name below base; one that leaves it is refused."""
    if ".." in name.split("/"):
        raise IllegalArgument(f"{name!r} is outside {base!r}")
    return f"{base.rstrip('/')}/{name.lstrip('/')}"


def encode(path: str) -> str:
    """Percent-encode what a URI path cannot hold; other scripts' letters stay."""
    return "".join(c if c.isascii() and (c.isalnum() or c in LITERAL) or not c.isascii() else "".join(f"%{b:02X}" for b in c.encode()) for c in path)


def physical(base: str, logged: str) -> str:
    """The file that a logged path names: decoded once, absolute."""
    plain = unquote(logged)
    return plain if SCHEME.match(plain) or plain.startswith("/") else f"{base.rstrip('/')}/{plain}"


def partition_values(relative: str) -> dict:
    """Values in the folder names of a relative path written by Spark; the null folder means null."""
    found = (p.partition("=") for p in relative.split("/")[:-1] if "=" in p)
    return {unquote(k): None if v == NULL_PARTITION else unquote(v) for k, _, v in found}
