"""Masking of secrets in audit payloads."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# A selection that mentions one of these has its value replaced by MASK.
SENSITIVE_WORDS = ("password", "secret", "privatekey", "credentials")
MASK = ["***"]


def _mask_udf():
    """Masking while the text is read, as a UDF that carries its own code, so workers need not have the package."""
    words, mask = SENSITIVE_WORDS, MASK

    def closed(pairs):
        """Called by the JSON reader for each object when its last field is read."""
        found = dict(pairs)
        chosen = found.get("selection")
        if "value" in found and isinstance(chosen, str) and any(word in chosen.lower() for word in words):
            found["value"] = mask
        return found

    def mask_text(text):
        try:
            return json.dumps(json.loads(text, object_pairs_hook=closed), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return text
        except RecursionError:  # too deep to be looked through, so nothing of it is shown
            return json.dumps(mask)

    def mask_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(mask_text, na_action="ignore")

    return F.pandas_udf(mask_batches, "string")


def may_need_masking(payload: Column) -> Column:
    """A cheap test no payload that needs masking fails; escaped letters could hide a word."""
    lowered = F.lower(payload)
    return payload.contains("\\u") | (
        lowered.contains("selection") & lowered.rlike("|".join(SENSITIVE_WORDS))
    )


def mask_payload(payload: Column) -> Column:
    """Replace ``value`` beside a sensitive ``selection``, at any depth of the JSON text.

    A payload nested too deep for the JSON reader (some ten thousand levels) is replaced as a whole.
    Nesting is unbounded, which no built-in expresses, so suspicious payloads go
    through one Arrow UDF; all others reach it as NULL and keep their text.
    """
    suspicious = F.when(may_need_masking(payload), payload)
    return F.coalesce(_mask_udf()(suspicious), payload)
