"""Splitting one text into overlapping chunks; used inside Arrow batches."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from textlake.functions.fixed_values import CHUNK_SEPARATORS


def _cut(text: str, start: int, end: int, separator: str) -> list[tuple[int, int]]:
    """Spans between separators; each separator opens the span it stands before."""
    if not separator:
        return [(at, at + 1) for at in range(start, end)]
    cuts, at = [start], text.find(separator, start, end)
    while at >= 0:
        if at > start:
            cuts.append(at)
        at = text.find(separator, at + len(separator), end)
    return list(zip(cuts, [*cuts[1:], end], strict=True))


def _pieces(
    text: str, start: int, end: int, size: int, separators: Sequence[str]
) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring spans below ``size``; a longer span is cut finer.

    Chunks never join spans of two runs.
    """
    level = next(
        (i for i, sep in enumerate(separators) if not sep or text.find(sep, start, end) >= 0),
        len(separators) - 1,
    )
    finer = separators[level + 1 :]
    runs: list[list[tuple[int, int]]] = [[]]
    for span in _cut(text, start, end, separators[level]):
        if span[1] - span[0] < size or not finer:
            runs[-1].append(span)
        else:
            runs += [*_pieces(text, *span, size, finer), []]
    return [run for run in runs if run]


def split_text(
    text: str,
    size: int,
    overlap: int,
    separators: Sequence[str] = CHUNK_SEPARATORS,
) -> list[str]:
    """Chunks of at most ``size`` characters, cut where the text pauses.

    Paragraphs come first, then lines, then words, then single characters. A
    chunk starts with up to ``overlap`` characters of the one before it, as far
    as whole pieces allow. Chunks are stripped and never empty.
    """
    found: list[str] = []
    for run in _pieces(text, 0, len(text), size, separators):
        window: deque[tuple[int, int]] = deque()
        for span in run:
            width = span[1] - span[0]
            if window and window[-1][1] - window[0][0] + width > size:
                found.append(text[window[0][0] : window[-1][1]].strip())
                while window and (
                    (length := window[-1][1] - window[0][0]) > overlap or length + width > size
                ):
                    window.popleft()
            window.append(span)
        found.append(text[window[0][0] : window[-1][1]].strip())
    return [chunk for chunk in found if chunk]
