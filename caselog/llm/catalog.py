"""All registered corpus queries."""

from caselog.llm import (
    centroids,
    chat_format,
    language_id,
    mixing,
    nearest,
    packing,
    phrases,
    quality,
    secrets,
    simhash,
    spot_signatures,
    url_filter,
    wrappers,
)
from caselog.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
