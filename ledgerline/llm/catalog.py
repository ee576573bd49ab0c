"""Import point that has all modules of this package register their queries."""

from ledgerline.llm import (  # noqa: F401
    embedding_dup,
    id_files,
    licenses,
    mixing,
    near_dup,
    neighbours,
    packing,
    periodic,
    quality,
    repeats,
    slack,
    trie,
    warc,
)
from ledgerline.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
