"""Splitting reader for block-gzipped text (`.bgz`).

A `.bgz` file is a chain of gzip members of at most 64 KiB, each of which states its
own size. So a file can be cut at byte offsets: a split owns the members that start
inside it, drops the text up to its first line end (the split before reads that) and
reads on to the first line end after its last member.
"""

import zlib

MAGIC = b"\x1f\x8b\x08\x04"
PROBE = 1 << 17
BATCH_BYTES = 8 << 20


def open_binary(path: str):
    """Seekable binary file for a local or remote path."""
    if path.startswith("file:"):
        from urllib.parse import unquote, urlparse
        return open(unquote(urlparse(path).path), "rb")
    if "://" in path:
        from pyarrow import fs
        system, inner = fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(path, "rb")


def _member_size(header: bytes) -> int:
    """Size of the member at the start of `header`, 0 when it is none of a block chain."""
    if len(header) < 18 or header[:4] != MAGIC:
        return 0
    extra = int.from_bytes(header[10:12], "little")
    at, stop = 12, 12 + extra
    while at + 4 <= min(stop, len(header)):
        size = int.from_bytes(header[at + 2:at + 4], "little")
        if header[at:at + 2] == b"BC" and size == 2 and at + 6 <= len(header):
            return int.from_bytes(header[at + 4:at + 6], "little") + 1
        at += 4 + size
    return 0


def is_blocked(path: str) -> bool:
    with open_binary(path) as f:
        return _member_size(f.read(64)) > 0


def _first_member(f, start: int, length: int) -> int:
    """Offset of the first member that starts at or after `start`, `length` if none."""
    at = start
    while at < length:
        f.seek(at)
        window = f.read(PROBE)
        found = window.find(MAGIC)
        while found >= 0:
            here = at + found
            size = _member_size(window[found:found + 64]) or _reread_size(f, here)
            if size and (here + size == length or _reread_size(f, here + size)):
                return here
            found = window.find(MAGIC, found + 1)
        at += max(len(window) - len(MAGIC) + 1, 1)
        if len(window) < PROBE:
            break
    return length


def _reread_size(f, offset: int) -> int:
    f.seek(offset)
    return _member_size(f.read(64))


def _members(f, offset: int, length: int):
    """(offset, text) of the members from `offset` on."""
    while offset < length:
        size = _reread_size(f, offset)
        if not size:
            raise ValueError(f"broken block chain at byte {offset}")
        f.seek(offset)
        yield offset, zlib.decompress(f.read(size), wbits=31)
        offset += size


def split_text(path: str, start: int, stop: int, length: int):
    """Text of the lines that belong to the byte range [start, stop), in pieces that end
    at a line end."""
    with open_binary(path) as f:
        offset = _first_member(f, start, length)
        skip = start > 0
        tail, held = [], 0
        for at, text in _members(f, offset, length):
            beyond = at >= stop
            if beyond and skip:
                return
            if skip:
                cut = text.find(b"\n")
                if cut < 0:
                    continue
                text, skip = text[cut + 1:], False
            if beyond:
                cut = text.find(b"\n")
                tail.append(text if cut < 0 else text[:cut + 1])
                if cut >= 0:
                    break
                continue
            tail.append(text)
            held += len(text)
            if held >= BATCH_BYTES:
                joined = b"".join(tail)
                cut = joined.rfind(b"\n") + 1
                if cut:
                    yield joined[:cut]
                tail, held = [joined[cut:]], 0
        rest = b"".join(tail)
        if rest:
            yield rest


def stream_text(path: str):
    """Whole text of a plain gzip file in pieces that end at a line end."""
    with open_binary(path) as f:
        codec, rest = zlib.decompressobj(wbits=31), b""
        while chunk := f.read(BATCH_BYTES // 4):
            while chunk:
                rest += codec.decompress(chunk)
                chunk = codec.unused_data
                if codec.eof:
                    codec = zlib.decompressobj(wbits=31)
            cut = rest.rfind(b"\n") + 1
            if cut:
                yield rest[:cut]
                rest = rest[cut:]
        if rest:
            yield rest
