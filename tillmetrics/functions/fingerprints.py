"""Content fingerprint of a delivered batch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_fingerprint(content: Column, sender: Column, client: Column) -> Column:
    """SHA-256 over the batch text, who sent it and for whom.

    Equal content from another sender or client is another batch. The separator
    is a control character, so ``("ab", "c")`` and ``("a", "bc")`` differ.
    """
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in (client, sender, content)]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)
