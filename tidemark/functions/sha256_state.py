"""A SHA-256 that is put down after any byte and taken up again by another process.

``hashlib`` computes the same digest but keeps its state to itself. The library below it, OpenSSL, has the state as
a plain structure of fixed size, whose bytes go from one task to the next.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib

# Fixed value: eight words of state, two of length, a block of sixteen, two of bookkeeping.
STATE_BYTES = 4 * 28


@functools.lru_cache(maxsize=None)
def _library():
    """The functions of the library that ``hashlib`` itself uses, or None where they cannot be called."""
    try:
        import _hashlib

        library = ctypes.CDLL(_hashlib.__file__)
        begin, update, final = library.SHA256_Init, library.SHA256_Update, library.SHA256_Final
    except (ImportError, AttributeError, OSError):
        return None
    update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
    begin.argtypes, final.argtypes = [ctypes.c_void_p], [ctypes.c_void_p, ctypes.c_void_p]
    return begin, update, final


class Sha256:
    """``Sha256(state)`` goes on where the hash stood that gave ``state``; without one it begins."""

    def __init__(self, state: bytes | None = None):
        self._begin, self._update, self._final = _library()
        self._context = ctypes.create_string_buffer(STATE_BYTES)
        if state is None:
            self._begin(self._context)
        else:
            self._context[:] = state

    def update(self, data: bytes) -> None:
        self._update(self._context, data, len(data))

    def state(self) -> bytes:
        return self._context.raw

    def hexdigest(self) -> str:
        closed, digest = ctypes.create_string_buffer(self._context.raw, STATE_BYTES), ctypes.create_string_buffer(32)
        self._final(digest, closed)
        return digest.raw.hex()


@functools.lru_cache(maxsize=None)
def available() -> bool:
    """Whether the state can be had here, tried on a text of several blocks that is put down in the middle of one."""
    if _library() is None:
        return False
    text = bytes(range(256))
    first = Sha256()
    first.update(text[:100])
    second = Sha256(first.state())
    second.update(text[100:])
    return second.hexdigest() == hashlib.sha256(text).hexdigest()
