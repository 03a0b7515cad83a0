"""Words of whole texts, for operators that hash runs of words.

Words are the longest runs of bytes other than space and U+0009..U+000D, which is how
``bytes.split`` cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

BLOCK_BYTES = 1 << 21
SPACE = re.compile(rb"[ \t-\r]")


def word_blocks(text: bytes, overlap: int, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first word, words) for blocks of a text; neighbours share ``overlap`` words.

    Memory stays bounded however long the text: a text of up to ``block_bytes`` is one block.
    """
    at, begin, carry = 0, 0, []
    while begin < len(text) or begin == 0:
        end = len(text)
        if end - begin > block_bytes:
            cut = SPACE.search(text, begin + block_bytes)
            end = cut.start() if cut else end
        words = carry + text[begin:end].split()
        if words or begin == 0:
            yield at - len(carry), words
        at += len(words) - len(carry)
        carry = words[-overlap:] if overlap else []
        begin = max(end, begin + 1)
