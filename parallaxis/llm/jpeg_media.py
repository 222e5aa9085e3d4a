"""Media columns: payloads as baseline JPEG, read back through DC-only decoding.

A payload byte is the level of one 8x8 block, so the DC-only luminance
thumbnail of the stored image is the payload itself. The encoder uses
quantiser 8 for DC (a level step of exactly one), no AC coefficients and one
restart interval per row of blocks. The decoder is a general baseline
decoder: it reads any number of Huffman tables, components, sampling factors
and AC runs, and rebuilds the luminance DC plane only.

Both directions are vectorised. Restart segments are independent, so the
decoder advances all segments of all images of a batch in lock step; a file
without restart markers is one segment.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa

from parallaxis.llm.common import slices

#: Blocks per row of a stored payload; 24 rows of 24 make the padding unit.
ROW = 24
UNIT = 576
#: Rows of blocks per image: 65535 pixels at most, in whole units.
MOST_ROWS = 8184
#: Code lengths of the DC categories 0..8, canonical order (a fixed value of the stored form).
DC_LENGTHS = (3, 3, 3, 3, 3, 3, 4, 5, 6)


def canonical(lengths_count, symbols):
    """``(codes, lengths)`` by symbol of a JPEG Huffman table."""
    codes, sizes, code, k = {}, {}, 0, 0
    for size, count in enumerate(lengths_count, 1):
        for _ in range(count):
            codes[symbols[k]], sizes[symbols[k]] = code, size
            code, k = code + 1, k + 1
        code <<= 1
    return codes, sizes


def _tables():
    counts = [sum(x == n for x in DC_LENGTHS) for n in range(1, 17)]
    return (counts, list(range(9))), ([1] + [0] * 15, [0])


def _dc_codes():
    """Code and length of block level differences -255..255, with the end-of-block bit."""
    (counts, symbols), _ = _tables()
    codes, sizes = canonical(counts, symbols)
    values, lengths = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for diff in range(-255, 256):
        category = abs(diff).bit_length()
        bits = diff if diff > 0 else diff + (1 << category) - 1
        values[diff + 255] = ((codes[category] << category) | (bits if category else 0)) << 1
        lengths[diff + 255] = sizes[category] + category + 1
    return values, lengths


def header(rows: int) -> bytes:
    """Everything of a stored image up to its entropy-coded data."""
    (dc_counts, dc_symbols), (ac_counts, ac_symbols) = _tables()
    marker = lambda code, body: struct.pack(">BBH", 0xFF, code, len(body) + 2) + body
    return b"".join(
        [
            b"\xff\xd8",
            marker(0xDB, bytes([0, 8] + [1] * 63)),
            marker(0xC0, struct.pack(">BHHBBBB", 8, rows * 8, ROW * 8, 1, 1, 0x11, 0)),
            marker(0xC4, bytes([0x00, *dc_counts, *dc_symbols])),
            marker(0xC4, bytes([0x10, *ac_counts, *ac_symbols])),
            marker(0xDD, struct.pack(">H", ROW)),
            marker(0xDA, bytes([1, 1, 0, 0, 63, 0])),
        ]
    )


def encode(payloads: list[bytes]) -> list[bytes]:
    """Stored form of payloads whose sizes are positive multiples of 576.

    Payloads above 8184 rows of 24 blocks become several images in a row.
    """
    step = MOST_ROWS * ROW
    images = [[p[i : i + step] for i in range(0, len(p), step)] for p in payloads]
    scans = (s for group in _groups([x for parts in images for x in parts], len) for s in _scans(group))
    return [b"".join(header(len(x) // ROW) + next(scans) + b"\xff\xd9" for x in parts) for parts in images]


def _groups(items: list, size, most: int = 2 << 20):
    """Consecutive items, together up to ``most`` large or alone."""
    group, used = [], 0
    for x in items:
        if group and used + size(x) > most:
            yield group
            group, used = [], 0
        group.append(x)
        used += size(x)
    if group:
        yield group


def _scans(parts: list[bytes]) -> list[bytes]:
    values, lengths = _dc_codes()
    level = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16).reshape(-1, ROW)
    diff = np.empty_like(level)
    diff[:, 0] = level[:, 0] - 128
    np.subtract(level[:, 1:], level[:, :-1], out=diff[:, 1:])
    diff = (diff + 255).astype(np.intp)
    code, size = values[diff], lengths[diff]
    bits = size.sum(1)
    width = (bits + 7) >> 3
    start = np.concatenate([[0], np.cumsum(width)])
    at = (start[:-1] * 8)[:, None] + np.cumsum(size, 1) - size
    shifted = code << (32 - size - (at & 7))
    total = int(start[-1])
    raw = np.zeros(total + 4, np.uint8)
    first = (at >> 3).ravel()
    for k in range(4):
        part = ((shifted >> (24 - 8 * k)) & 255).ravel()
        live = np.flatnonzero(part) if k > 1 else slice(None)
        raw += np.bincount(first[live] + k, part[live], len(raw)).astype(np.uint8)
    pad = (width * 8 - bits).astype(np.int64)
    raw[start[1:] - 1] |= ((1 << pad) - 1).astype(np.uint8)
    raw = raw[:total]
    rows = np.array([len(p) // ROW for p in parts])
    last = np.cumsum(rows) - 1
    number = np.arange(len(width)) - np.repeat(last + 1 - rows, rows)
    stuffed = raw == 255
    inside = np.cumsum(stuffed)
    marks = np.ones(len(width), np.int64)
    marks[last] = 0
    before = np.concatenate([[0], np.cumsum(marks)])
    row_of = np.repeat(np.arange(len(width)), width)
    place = np.arange(total) + (inside - stuffed) + 2 * before[row_of]
    out = np.zeros(total + int(inside[-1]) + 2 * int(before[-1]), np.uint8)
    out[place] = raw
    tail = place[start[1:] - 1] + 1 + stuffed[start[1:] - 1]
    marked = marks.astype(bool)
    out[tail[marked]] = 255
    out[tail[marked] + 1] = 0xD0 + (number[marked] & 7)
    data, ends = out.tobytes(), tail[last]
    return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def parse(data: bytes) -> list[dict]:
    """The images of a stored form: tables, frame, restart interval and place of each scan."""
    images, at = [], 0
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError(f"no start of image at byte {at}")
        at, image = at + 2, {"quant": {}, "dc": {}, "ac": {}, "restart": 0}
        while True:
            while data[at : at + 2] == b"\xff\xff":
                at += 1
            code, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if code == 0xDB:
                while body:
                    wide = body[0] >> 4
                    n = 128 if wide else 64
                    image["quant"][body[0] & 15] = struct.unpack_from(">H" if wide else ">B", body, 1)[0]
                    body = body[1 + n :]
            elif code in (0xC0, 0xC1):
                bits, height, width, count = struct.unpack_from(">BHHB", body)
                if bits != 8:
                    raise ValueError("only 8-bit samples are baseline")
                image |= {"height": height, "width": width, "parts": [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(count)]}
            elif 0xC2 <= code <= 0xCF and code not in (0xC4, 0xC8, 0xCC):
                raise ValueError(f"frame type {code:#x} is not baseline")
            elif code == 0xC4:
                while body:
                    counts = list(body[1:17])
                    n = sum(counts)
                    image["ac" if body[0] >> 4 else "dc"][body[0] & 15] = (counts, list(body[17 : 17 + n]))
                    body = body[17 + n :]
            elif code == 0xDD:
                image["restart"] = struct.unpack(">H", body)[0]
            elif code == 0xDA:
                image["tables"] = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])}
                break
        image["scan"] = at
        end = at
        while True:
            end = data.find(b"\xff", end)
            if end < 0 or end + 1 >= len(data):
                raise ValueError("the scan does not end")
            if data[end + 1] == 0 or 0xD0 <= data[end + 1] <= 0xD7:
                end += 2
                continue
            break
        if data[end + 1] != 0xD9:
            raise ValueError("more than one scan")
        image["end"] = end
        at = end + 2
        images.append(image)
    return images


def lookup(counts, symbols) -> np.ndarray:
    """Of each 16-bit window: code length * 256 + symbol (0: no code)."""
    out = np.zeros(65536, np.int32)
    codes, sizes = canonical(counts, symbols)
    for s, code in codes.items():
        n = sizes[s]
        out[code << (16 - n) : (code + 1) << (16 - n)] = n * 256 + s
    return out


def luminance_dc(stored: list[bytes]) -> list[list[np.ndarray]]:
    """The DC-only luminance thumbnails, one uint8 plane per image, of each stored form."""
    parsed = [parse(x) for x in stored]
    groups: dict[tuple, list] = {}
    for n, images in enumerate(parsed):
        for k, image in enumerate(images):
            shape = (str(image["parts"]), str(image["tables"]), str(image["dc"]), str(image["ac"]), str(image["quant"]), image["restart"])
            groups.setdefault(shape, []).append((n, k))
    out: list[list] = [[None] * len(images) for images in parsed]
    extent = lambda x: parsed[x[0]][x[1]]["end"] - parsed[x[0]][x[1]]["scan"]
    for members in (part for kind in groups.values() for part in _groups(kind, extent)):
        images = [parsed[n][k] for n, k in members]
        planes = _planes([stored[n] for n, _ in members], images)
        for (n, k), plane in zip(members, planes, strict=True):
            out[n][k] = plane
    return out


def _planes(files: list[bytes], images: list[dict]) -> list[np.ndarray]:
    """Decode images of one kind together, all restart segments in lock step."""
    one = images[0]
    single = len(one["parts"]) == 1
    most_h, most_v = max(p[1] for p in one["parts"]), max(p[2] for p in one["parts"])
    order = [k for k, p in enumerate(one["parts"]) for _ in range(1 if single else p[1] * p[2])]
    first_h, first_v, quant = (1, 1) + (one["parts"][0][3],) if single else one["parts"][0][1:]
    mcus = []
    for x in images:
        wide = (8 if single else 8 * most_h)
        high = (8 if single else 8 * most_v)
        mcus.append((-(-x["width"] // wide), -(-x["height"] // high)))
    scans = [np.frombuffer(f, np.uint8)[x["scan"] : x["end"]] for f, x in zip(files, images, strict=True)]
    buffer = np.concatenate(scans)
    lead = np.concatenate([[False], buffer[:-1] == 255])
    lead[np.cumsum([0] + [len(s) for s in scans[:-1]])] = False
    mark = lead & (buffer >= 0xD0) & (buffer <= 0xD7)
    drop = mark | (lead & (buffer == 0))
    drop[:-1] |= mark[1:]
    kept = np.flatnonzero(~drop)
    clean = buffer[kept]
    place = np.cumsum(~drop)
    marks_at = np.flatnonzero(mark)
    edges = np.cumsum([0] + [len(s) for s in scans])
    begin, todo, owner = [], [], []
    for n, (x, (w, h)) in enumerate(zip(images, mcus, strict=True)):
        inner = marks_at[np.searchsorted(marks_at, edges[n]) : np.searchsorted(marks_at, edges[n + 1])]
        starts = np.concatenate([[edges[n]], inner + 1])
        begin.append(np.where(starts > 0, place[np.maximum(starts, 1) - 1], 0))
        each = x["restart"] or w * h
        sizes = np.full(len(starts), each)
        sizes[-1] = w * h - each * (len(starts) - 1)
        if len(starts) != -(-w * h // each):
            raise ValueError("restart markers don't match the frame")
        todo.append(sizes)
        owner.append(np.full(len(starts), n))
    begin, todo = np.concatenate(begin), np.concatenate(todo)
    padded = np.concatenate([clean, np.full(8, 255, np.uint8)]).astype(np.uint32)
    window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    names = [p[0] for p in one["parts"]]
    dc = [lookup(*one["dc"][one["tables"][c][0]]) for c in names]
    ac = [lookup(*one["ac"][one["tables"][c][1]]) for c in names]
    end_first = [bool(t[0] >> 8) and (t[0] & 255) == 0 for t in ac]  # an end-of-block code of zeros: tested at once
    base = np.concatenate([[0], np.cumsum(todo)])
    per_first = order.count(0)
    levels = np.zeros(int(base[-1]) * per_first, np.int32)
    ranked = np.argsort(-todo, kind="stable")
    bit = (begin * 8)[ranked]
    sizes, where = todo[ranked], base[:-1][ranked] * per_first
    predicted = np.zeros((len(names), len(ranked)), np.int32)

    def peek(at):
        return ((window[at >> 3].astype(np.uint64) << np.uint64(8) | padded[(at >> 3) + 4]) >> (8 - (at & 7)).astype(np.uint64)).astype(np.int64) & 0xFFFFFFFF

    live = len(ranked)
    limit = len(window) * 8 - 8
    for step in range(int(sizes[0]) if len(sizes) else 0):
        while live and sizes[live - 1] <= step:
            live -= 1
        seen = 0
        for c in order:
            at = bit[:live]
            seen_bits = peek(np.minimum(at, limit))
            entry = dc[c][seen_bits >> 16]
            size, category = entry >> 8, entry & 255
            if (size == 0).any():
                raise ValueError("a code is not in its table")
            extra = (seen_bits >> (32 - size - category)) & ((1 << category) - 1)
            value = np.where(extra >= (1 << category) >> 1, extra, extra - (1 << category) + 1)
            value[category == 0] = 0
            predicted[c, :live] += value
            if c == 0:
                levels[where[:live] + step * per_first + seen] = predicted[0, :live]
                seen += 1
            at = at + size + category
            if end_first[c]:
                follow = (seen_bits >> np.maximum(31 - size - category, 0)) & 1
                open_rows = np.flatnonzero(follow)
                length = int(ac[c][0] >> 8)
                if length == 1:
                    at[follow == 0] += 1
                else:
                    open_rows = np.arange(live)
            else:
                open_rows = np.arange(live)
            k = np.ones(len(open_rows), np.int64)
            while len(open_rows):
                entry = ac[c][peek(np.minimum(at[open_rows], limit)) >> 16]
                size, run, category = entry >> 8, (entry & 255) >> 4, entry & 15
                if (size == 0).any():
                    raise ValueError("a code is not in its table")
                at[open_rows] += size + category
                over = (run < 15) & (category == 0)
                k = np.where(over, 64, k + run + 1)
                open_rows, k = open_rows[k < 64], k[k < 64]
            bit[:live] = at
    factor = images[0]["quant"][quant]
    pixel = np.clip(np.floor_divide(levels * factor + 4, 8) + 128, 0, 255).astype(np.uint8)
    out, at = [], 0
    for x, (w, h) in zip(images, mcus, strict=True):
        n = w * h * per_first
        plane = pixel[at : at + n].reshape(h, w, first_v, first_h).transpose(0, 2, 1, 3).reshape(h * first_v, w * first_h)
        own = (-(-x["height"] * first_v // (8 * most_v)), -(-x["width"] * first_h // (8 * most_h))) if not single else (h, w)
        out.append(plane[: own[0], : own[1]])
        at += n
    return out


def difference_hash(plane: np.ndarray) -> str:
    """64 bits: is each cell of an 8 x 9 box average brighter than its right neighbour."""
    rows = np.linspace(0, plane.shape[0], 9).astype(int)
    cols = np.linspace(0, plane.shape[1], 10).astype(int)
    total = np.zeros((plane.shape[0] + 1, plane.shape[1] + 1), np.int64)
    np.cumsum(np.cumsum(plane, 0, dtype=np.int64), 1, out=total[1:, 1:])
    r0, r1 = np.minimum(rows[:-1], plane.shape[0] - 1), np.maximum(rows[1:], np.minimum(rows[:-1], plane.shape[0] - 1) + 1)
    c0, c1 = np.minimum(cols[:-1], plane.shape[1] - 1), np.maximum(cols[1:], np.minimum(cols[:-1], plane.shape[1] - 1) + 1)
    cells = total[r1][:, c1] - total[r0][:, c1] - total[r1][:, c0] + total[r0][:, c0]
    cells = cells / ((r1 - r0)[:, None] * (c1 - c0))
    return np.packbits(cells[:, :-1] > cells[:, 1:]).tobytes().hex()


def pad_payload(raw: bytes) -> bytes:
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


def media_columns(docs, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False):
    """Store every text as JPEG media and describe what is read back.

    One row per input row: the id, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, width, height (of all images, in
    pixels) and feature, ``<width>x<height>:<difference hash of the
    thumbnail>``; with ``keep_media`` also the stored bytes. A null or empty
    text is one unit of 255s. Null ids and repeated rows pass through; other
    columns are ignored. Each batch is cut by bytes, so memory does not grow
    with the number of rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width long, height long, feature string" + ", media binary" * keep_media

    def run(batches):
        for whole in batches:
            for batch in slices(whole, text_col, 1 << 20):
                ids = batch.column(0)
                raws = [(x or "").encode("utf-8", "surrogatepass") for x in batch.column(1).to_pylist()]
                stored = encode([pad_payload(x) for x in raws])
                planes = luminance_dc(stored)
                rows = []
                for raw, media, images in zip(raws, stored, planes, strict=True):
                    back = b"".join(p.tobytes() for p in images)
                    plane = images[0] if len(images) == 1 else np.concatenate(images)
                    high, wide = plane.shape[0] * 8, plane.shape[1] * 8
                    rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), wide, high, f"{wide}x{high}:{difference_hash(plane)}") + ((media,) if keep_media else ()))
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "width", "height", "feature"] + ["media"] * keep_media
                yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    return docs.select(id_col, docs[text_col].cast("string").alias(text_col)).mapInArrow(run, schema)
