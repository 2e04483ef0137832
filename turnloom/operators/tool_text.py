"""Tool results inside turn texts: noise lines off, long ones cut in the middle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.fixed import NOISE_LINES, RESULT_BLOCK as _BLOCK, RESULT_CHARS, RESULT_MARK, RESULT_MARK_ROOM
from ..functions.text import strip


def clean_result(body: Column) -> Column:
    noise = "|".join(NOISE_LINES)
    return strip(F.array_join(F.filter(F.split(body, "\n", -1), lambda line: ~line.rlike(noise)), "\n"))


def cut_result(body: Column, limit: int = RESULT_CHARS) -> Column:
    """Over ``limit``, the first three fifths and the end, with a mark between; the mark is one longer than its room."""
    head, tail = limit * 3 // 5, limit - limit * 3 // 5 - RESULT_MARK_ROOM
    short = F.concat(F.substring(body, 1, head), F.lit(RESULT_MARK), F.right(body, F.lit(tail)) if tail > 0 else F.lit(""))
    return F.when(F.length(body) <= limit, body).otherwise(short)


def normalize(content: Column, limit: int = RESULT_CHARS) -> Column:
    """The same done to each tool result in the content: gaps and matches are taken apart, matches changed, both put together."""
    blocks = F.regexp_extract_all(content, F.lit(_BLOCK), 0)
    gaps = F.split(content, _BLOCK, -1)

    def changed(block: Column) -> Column:
        tag = F.regexp_extract(block, _BLOCK, 1)
        body = F.regexp_extract(block, _BLOCK, 2)
        return F.concat(tag, F.lit("\n"), cut_result(clean_result(body), limit), F.lit("\n</tool_result>"))

    put = F.zip_with(gaps, F.transform(blocks, changed), lambda gap, block: F.concat(gap, F.coalesce(block, F.lit(""))))
    return F.when(F.size(blocks) > 0, F.array_join(put, "")).otherwise(content)


def normalize_turns(turns: Column, limit: int = RESULT_CHARS) -> Column:
    return F.transform(turns, lambda t: t.withField("content", normalize(t.content, limit)))
