"""Words of UTF-8 texts, cut at ASCII bytes only."""

from __future__ import annotations

# Texts are split in chunks of this size, so that the words of a very long
# text never lie in memory all at once.
CHUNK = 1 << 20
# Stands for a break between pieces; this byte occurs in no UTF-8 text.
BREAK = b"\xff"

_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PIECES = bytes.maketrans(_ENDS, BREAK * len(_ENDS))
# Everything in ASCII but digits and letters separates words.
_APART = bytes(b for b in range(128) if not chr(b).isalnum())
_PLAIN = bytes.maketrans(_APART, b" " * len(_APART))


def chunks(data: bytes, size: int = CHUNK):
    """The text in parts of about ``size`` bytes, each but the first beginning
    with a space or line end (a longer run without one is one part)."""
    at = 0
    while len(data) - at > size:
        cut = max(data.rfind(b" ", at, at + size), data.rfind(b"\n", at, at + size))
        if cut <= at:
            after = [c for c in (data.find(b" ", at + size), data.find(b"\n", at + size)) if c > 0]
            if not after:
                break
            cut = min(after)
        yield data[at:cut]
        at = cut
    yield data[at:]


def piece_tokens(data: bytes) -> list[bytes]:
    """Lower-case words, split at spaces and tabs, with :data:`BREAK` at each
    mark or line end that ends a piece."""
    return data.lower().translate(_PIECES).replace(BREAK, b" \xff ").split()


def alnum_words(data: bytes) -> list[bytes]:
    """Lower-case runs of ASCII letters and digits and of bytes past ASCII."""
    return data.translate(_PLAIN).lower().split()


def space_words(data: bytes) -> list[bytes]:
    """Lower-case runs of other bytes than ASCII white space."""
    return data.lower().split()
