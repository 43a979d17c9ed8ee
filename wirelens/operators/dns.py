"""DNS messages to structs. Malformed input never fails: what can be read is kept, with warnings."""

from __future__ import annotations

import ipaddress
from struct import unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wirelens.functions.arrow import flat, laid, taken
from wirelens.functions.names import RR_TYPES

_RECORDS = T.ArrayType(flat("name:string,type:int,type_name:string,class:int,ttl:long,rdata:binary,text:string,malformed:boolean"))
MESSAGE = (
    flat("id:int,qr:boolean,opcode:int,aa:boolean,tc:boolean,rd:boolean,ra:boolean,ad:boolean,cd:boolean,rcode:int,qdcount:int,ancount:int,nscount:int,arcount:int")
    .add("questions", T.ArrayType(flat("qname:string,qname_wire:binary,qtype:int,qtype_name:string,qclass:int")))
    .add("answers", _RECORDS).add("authority", _RECORDS).add("additional", _RECORDS)
    .add("edns", flat("udp_size:int,extended_rcode:int,version:int,do_bit:boolean").add("options", T.ArrayType(flat("code:int,value:binary"))))
    .add("warnings", T.ArrayType(flat("code:string,path:string")))
)
MAX_NAME, MAX_JUMPS = 255, 128
ARROW = to_arrow_type(MESSAGE)


def _lower(label: str) -> str:
    return "".join(c.lower() if c < "\x80" else c for c in label)


def name_at(raw: bytes, at: int) -> tuple[str, int, bool]:
    """A name in lower case without final dot, the bytes it takes where it stands, and whether it is well-formed.

    A pointer must lead backward. Bytes of labels are taken as they are (latin-1).
    """
    labels, octets, jumps, pos, taken = [], 0, 0, at, 0
    while pos < len(raw):
        n = raw[pos]
        if n == 0:
            return ".".join(labels), taken or pos + 1 - at, True
        if n >= 0xC0 and pos + 1 < len(raw):
            taken = taken or pos + 2 - at
            target = (n & 0x3F) << 8 | raw[pos + 1]
            jumps += 1
            if target >= pos or jumps > MAX_JUMPS:
                break
            pos = target
        elif n < 0x40 and pos + 1 + n <= len(raw) and octets + n + 1 <= MAX_NAME:
            octets += n + 1
            labels.append(_lower(raw[pos + 1 : pos + 1 + n].decode("latin-1")))
            pos += 1 + n
        else:
            break
    return ".".join(labels), taken, False


def rdata_text(raw: bytes, kind: int, at: int, size: int) -> tuple[str, bool]:
    """The record's data as text ('' for kinds without one), and whether it is well-formed."""
    data = raw[at : at + size]
    if kind in (1, 28):
        fits = size == (4 if kind == 1 else 16)
        return (str(ipaddress.ip_address(data)) if fits else ""), fits
    if kind in (2, 5, 12):
        name, _, fine = name_at(raw, at)
        return name, fine
    fixed = {15: 1, 33: 3}.get(kind)
    if fixed:
        if size < 2 * fixed + 1 or len(raw) < at + 2 * fixed:
            return "", False
        name, _, fine = name_at(raw, at + 2 * fixed)
        return " ".join([*map(str, unpack_from(f">{fixed}H", raw, at)), name]), fine
    if kind == 6:
        first, n, fine = name_at(raw, at)
        second, m, fine2 = name_at(raw, at + n)
        if not (n and m) or at + n + m + 20 > len(raw):
            return "", False
        return " ".join([first, second, *map(str, unpack_from(">5I", raw, at + n + m))]), fine and fine2
    if kind == 16:
        parts, pos = [], 0
        while pos < size and pos + 1 + data[pos] <= size:
            parts.append(data[pos + 1 : pos + 1 + data[pos]].decode("latin-1"))
            pos += 1 + data[pos]
        return " ".join(parts), pos == size
    return "", True


def parsed(raw: bytes | None) -> dict | None:
    """One message as nested values; null if shorter than a header."""
    if raw is None or len(raw) < 12:
        return None
    raw = bytes(raw)
    id_, flags, *counts = unpack_from(">6H", raw)
    bit = lambda k: bool(flags >> k & 1)
    warnings: list[dict] = []
    out = {"id": id_, "qr": bit(15), "opcode": flags >> 11 & 15, "aa": bit(10), "tc": bit(9), "rd": bit(8), "ra": bit(7), "ad": bit(5), "cd": bit(4), "rcode": flags & 15, **dict(zip(("qdcount", "ancount", "nscount", "arcount"), counts, strict=True)), "edns": None, "warnings": warnings}
    warn = lambda code, path: warnings.append({"code": code, "path": path})
    pos, questions = 12, []
    for i in range(counts[0]):
        if pos >= len(raw):
            warn("dns_section_truncated", "questions")
            break
        name, n, fine = name_at(raw, pos)
        if n == 0:
            warn("dns_question_truncated", f"questions[{i}].qname")
            pos = len(raw)
            break
        if not fine:
            warn("dns_name_malformed", f"questions[{i}].qname")
        if pos + n + 4 > len(raw):
            warn("dns_question_truncated", f"questions[{i}]")
            pos = len(raw)
            break
        kind, class_ = unpack_from(">2H", raw, pos + n)
        questions.append({"qname": name, "qname_wire": raw[pos : pos + n], "qtype": kind, "qtype_name": RR_TYPES.get(kind, f"TYPE{kind}"), "qclass": class_})
        pos += n + 4
    out["questions"] = questions
    for section, count in zip(("answers", "authority", "additional"), counts[1:], strict=True):
        records = out[section] = []
        for i in range(count):
            if pos >= len(raw):
                warn("dns_section_truncated", section)
                break
            name, n, fine = name_at(raw, pos)
            if n == 0 or pos + n + 10 > len(raw):
                if n:
                    warn("dns_rr_truncated", f"{section}[{i}]")
                pos = len(raw)
                break
            kind, class_, ttl, size = unpack_from(">HHIH", raw, pos + n)
            at = pos + n + 10
            over = at + size > len(raw)
            if over:
                warn("dns_rdata_overrun", f"{section}[{i}].rdata")
                size = len(raw) - at
            elif not fine:
                warn("dns_name_malformed", f"{section}[{i}].name")
            pos = at + size
            if kind == 41 and section == "additional":
                if out["edns"]:
                    warn("dns_multiple_opt", "additional")
                    continue
                options, o = [], at
                while o + 4 <= pos:
                    code, length = unpack_from(">2H", raw, o)
                    if o + 4 + length > pos:
                        warn("dns_edns_option_overrun", "edns.options")
                    options.append({"code": code, "value": raw[o + 4 : min(pos, o + 4 + length)]})
                    o += 4 + length
                out["edns"] = {"udp_size": class_, "extended_rcode": ttl >> 24, "version": ttl >> 16 & 255, "do_bit": bool(ttl & 0x8000), "options": options}
                out["rcode"] |= (ttl >> 24) << 4
                continue
            text, good = rdata_text(raw, kind, at, size)
            records.append({"name": name, "type": kind, "type_name": RR_TYPES.get(kind, f"TYPE{kind}"), "class": class_, "ttl": ttl, "rdata": raw[at : at + size], "text": text, "malformed": over or not fine or not good})
    return out


def _plain(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Which messages are nothing but one question about an ASCII name without pointers, as most are; where their names end; and
    where labels after the first one begin."""
    size = end - start
    fine = size >= 12
    counts = np.zeros((len(start), 8), np.uint8)
    counts[fine] = data[start[fine, None] + np.arange(4, 12)]
    fine &= (counts == np.array([0, 1, 0, 0, 0, 0, 0, 0], np.uint8)).all(axis=1)
    at, dots = start + 12, []
    going = np.flatnonzero(fine & (at < end))
    fine[at >= end] = False
    while len(going):
        n = data[at[going]]
        more = n > 0
        going, n = going[more], n[more].astype(np.int64)
        if dots:
            dots[-1] = dots[-1][more]
        behind = at[going] + 1 + n
        good = (n < 0x40) & (behind < end[going]) & (behind - start[going] - 12 <= MAX_NAME)
        fine[going[~good]] = False
        going = going[good]
        if dots:
            dots[-1] = dots[-1][good]
        at[going] = behind[good]
        dots.append(at[going])
    fine &= at + 5 <= end
    return fine, at, dots


def _questions(data: np.ndarray, start: np.ndarray, name_end: np.ndarray, dots: list[np.ndarray]) -> pa.StructArray:
    """Plain messages at once."""
    n, number = len(start), lambda at: (data[at].astype(np.int32) << 8) | data[at + 1]
    flags, kind = number(start + 2), number(name_end + 1)
    text = data.copy()
    for places in dots:
        text[places] = ord(".")
    text = np.where((text >= 65) & (text <= 90), text + 32, text).astype(np.uint8)
    kinds, which = np.unique(kind, return_inverse=True)
    names = pa.array([RR_TYPES.get(k, f"TYPE{k}") for k in kinds.tolist()], pa.string()).take(pa.array(which))
    one = ARROW.field("questions").type
    values = {
        "id": number(start), "opcode": flags >> 11 & 15, "rcode": flags & 15, "qdcount": np.ones(n, np.int32), **{c: np.zeros(n, np.int32) for c in ("ancount", "nscount", "arcount")},
        **{c: (flags >> k & 1).astype(bool) for c, k in (("qr", 15), ("aa", 10), ("tc", 9), ("rd", 8), ("ra", 7), ("ad", 5), ("cd", 4))},
        "questions": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), pa.StructArray.from_arrays(
            [taken(text, np.minimum(start + 13, name_end), name_end, pa.string()), taken(data, start + 12, name_end + 1, pa.binary()), pa.array(kind), names, pa.array(number(name_end + 3))], fields=list(one.value_type)), type=one),
    }
    none = lambda kind: pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], kind.value_type), type=kind) if pa.types.is_list(kind) else pa.nulls(n, kind)
    return pa.StructArray.from_arrays([(values[f.name] if isinstance(values[f.name], pa.Array) else pa.array(values[f.name], f.type)) if f.name in values else none(f.type) for f in ARROW], fields=list(ARROW))


def parsed_batch(raw: pa.Array) -> pa.StructArray:
    """:func:`parsed` of a batch: plain messages at once, the others one by one."""
    data, start, end, _ = laid(raw)
    plain, name_end, dots = _plain(data, start, end)
    own = np.zeros(len(data), bool)
    own[data > 127] = True
    if own.any():  # a name beyond ASCII is no plain one
        above = np.concatenate([[0], np.cumsum(own)])
        odd = above[np.where(plain, name_end, start)] > above[np.where(plain, np.minimum(start + 12, len(data)), start)]
        plain &= ~odd
    places = np.flatnonzero(plain)
    rest = np.flatnonzero(~plain)
    if not len(rest):
        return _questions(data, start, name_end, dots)
    others = pa.array([parsed(v) for v in raw.take(pa.array(rest)).to_pylist()], ARROW)
    if not len(places):
        return others
    order = np.empty(len(raw), np.int64)
    order[np.concatenate([places, rest])] = np.arange(len(raw))
    return pa.concat_arrays([_questions(data, start[places], name_end[places], dots), others]).take(pa.array(order))


def parse(message: Column) -> Column:
    """Messages to structs, in Arrow batches."""

    @F.arrow_udf(MESSAGE)
    def each(values: pa.Array) -> pa.Array:
        return parsed_batch(values)

    return each(message)
