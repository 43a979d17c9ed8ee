"""Events as bytes and back: fields of a number, a kind and a value, as protocol buffers have them on the wire."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wirelens.functions.arrow import as_array, ends, flat, laid, taken
from wirelens.operators import delivery, dns
from wirelens.operators.events import LARGEST, LEG_NAMES
from wirelens.sources.tables import stored

VARINT, FIXED64, DELIMITED, FIXED32 = 0, 1, 2, 5
#: The numbers of fields and of named values.
VISIBILITY = {"VISIBILITY_PACKET_METADATA": 1, "VISIBILITY_HANDSHAKE_METADATA": 2, "VISIBILITY_CLASSIFIED_FLOW": 3, "VISIBILITY_PACKET_PAYLOAD": 4, "VISIBILITY_DECRYPTED_PAYLOAD": 5, "VISIBILITY_ENDPOINT_OBSERVED": 6}
CONFIDENCE = {"OBSERVATION_CONFIDENCE_OBSERVED": 1, "OBSERVATION_CONFIDENCE_DERIVED": 2, "OBSERVATION_CONFIDENCE_INFERRED": 3}
NETWORK = {"NETWORK_PROTOCOL_IPV4": 1, "NETWORK_PROTOCOL_IPV6": 2, "NETWORK_PROTOCOL_ARP": 3, "NETWORK_PROTOCOL_OTHER": 255}
TRANSPORT = {"TRANSPORT_PROTOCOL_TCP": 1, "TRANSPORT_PROTOCOL_UDP": 2, "TRANSPORT_PROTOCOL_ICMP": 3, "TRANSPORT_PROTOCOL_ICMPV6": 4, "TRANSPORT_PROTOCOL_SCTP": 5, "TRANSPORT_PROTOCOL_OTHER": 255}
LEGS = {name: number for number, name in enumerate(LEG_NAMES.values(), 1)}
ENVELOPE = {
    "event_id": 1, "schema_version": 2, "source_type": 3, "source_host": 4, "source_instance": 5, "capture_interface": 6, "observation_method": 7, "observed_time_unix_nano": 8,
    "ingest_time_unix_nano": 9, "event_type": 10, "visibility": (11, VISIBILITY), "confidence": (12, CONFIDENCE), "payload_schema": 13, "stream_name": 14,
}
PACKET = {
    "observed_time_unix_nano": 1, "link": (3, {"src_mac": 1, "dst_mac": 2, "vlan_ids": 3, "ethertype": 4}),
    "network": (4, {"protocol": (1, NETWORK), "src_ip": 2, "dst_ip": 3, "next_header": 4, "ttl_or_hop_limit": 5, "dscp": 6, "ecn": 7, "fragmented": 8, "fragment_offset": 9}),
    "transport": (5, {
        "protocol": (1, TRANSPORT), "ip_protocol_number": 2, "src_port": 3, "dst_port": 4, "tcp": (10, {"flags": 1, "payload_len": 3}), "udp": (11, {"length": 1, "checksum_present": 2}),
    }),
    "packet_len": 20, "captured_len": 21, "truncated": 22,
}
RECORD = {"name": 1, "type": 2, "type_name": 3, "class": 4, "ttl": 5, "rdata_raw": 6, "rdata_text": 7, "malformed": 8}
MESSAGE = {
    "header": (1, {"id": 1, "qr": 2, "opcode": 3, "aa": 4, "tc": 5, "rd": 6, "ra": 7, "ad": 8, "cd": 9, "rcode": 10, "qdcount": 11, "ancount": 12, "nscount": 13, "arcount": 14}),
    "questions": (2, {"qname": 1, "qname_wire": 2, "qtype": 3, "qtype_name": 4, "qclass": 5}), "answers": (3, RECORD), "authority": (4, RECORD), "additional": (5, RECORD),
    "edns": (6, {"udp_payload_size": 1, "extended_rcode": 2, "version": 3, "do_bit": 4, "options": (5, {"code": 1, "length": 3, "raw_value": 4})}),
    "raw_dns_payload": 20, "raw_payload_truncated": 21,
}
EVENT = {
    "envelope": (1, ENVELOPE),
    "dns_transaction": (23, {
        "query_packet": (1, PACKET), "response_packet": (2, PACKET), "query": (3, MESSAGE), "response": (4, MESSAGE), "role": (5, LEGS), "rtt_nanos": 6, "rtt_valid": 7, "transaction_key": 8,
        "client_ip": 9, "client_port": 10, "server_ip": 11, "service_role": 12, "parser_warnings": (20, {"code": 1, "field_path": 3}),
    }),
}


def _parts(kind: T.StructType, numbers: dict) -> list[tuple[str, str, int, dict | list]]:
    """(name, how it is written, number, what is inside) of a struct's fields, in their order."""
    out = []
    for f in kind.fields:
        number, inner = numbers[f.name] if isinstance(numbers[f.name], tuple) else (numbers[f.name], {})
        many = isinstance(f.dataType, T.ArrayType)
        one = f.dataType.elementType if many else f.dataType
        if isinstance(one, T.StructType):
            out.append((f.name, "messages" if many else "message", number, _parts(one, inner)))
        elif isinstance(numbers[f.name], tuple) and isinstance(inner, dict) and isinstance(one, T.BinaryType):
            out.append((f.name, "encoded", number, {}))
        elif many:
            out.append((f.name, "numbers", number, {"bits": _bits(one)}))
        elif inner:
            out.append((f.name, "named", number, inner))
        elif isinstance(one, T.BooleanType):
            out.append((f.name, "flag", number, {}))
        elif isinstance(one, (T.StringType, T.BinaryType)):
            out.append((f.name, "text" if isinstance(one, T.StringType) else "bytes", number, {}))
        else:
            out.append((f.name, "number", number, {"bits": _bits(one)}))
    return out


_PACKET = (
    flat("observed_time_unix_nano:long").add("link", T.StructType([*flat("src_mac:string,dst_mac:string"), T.StructField("vlan_ids", T.ArrayType(T.IntegerType())), *flat("ethertype:int")]))
    .add("network", flat("protocol:string,src_ip:string,dst_ip:string,next_header:int,ttl_or_hop_limit:int,dscp:int,ecn:int,fragmented:boolean,fragment_offset:int"))
    .add("transport", flat("protocol:string,ip_protocol_number:int,src_port:int,dst_port:int").add("tcp", flat("flags:int,payload_len:int")).add("udp", flat("length:int,checksum_present:boolean")))
    .add("packet_len", "long").add("captured_len", "long").add("truncated", "boolean")
)
_RECORDS = T.ArrayType(flat("name:string,type:int,type_name:string,class:int,ttl:long,malformed:boolean,rdata_raw:binary,rdata_text:string"))
_MESSAGE = (
    T.StructType().add("header", flat("id:int,qr:boolean,opcode:int,aa:boolean,tc:boolean,rd:boolean,ra:boolean,ad:boolean,cd:boolean,rcode:int,qdcount:int,ancount:int,nscount:int,arcount:int"))
    .add("questions", T.ArrayType(flat("qname:string,qname_wire:binary,qtype:int,qtype_name:string,qclass:int"))).add("answers", _RECORDS).add("authority", _RECORDS).add("additional", _RECORDS)
    .add("edns", flat("udp_payload_size:int,extended_rcode:int,version:int,do_bit:boolean").add("options", T.ArrayType(flat("code:int,length:int,raw_value:binary"))))
    .add("raw_dns_payload", "binary").add("raw_payload_truncated", "boolean")
)
#: An event as ``events.dns_events`` makes it.
KIND = T.StructType().add("envelope", T.StructType([T.StructField(c, T.IntegerType() if c == "schema_version" else T.LongType() if c.endswith("_nano") else T.StringType()) for c in ENVELOPE])).add("dns_transaction", (
    T.StructType().add("query_packet", _PACKET).add("response_packet", _PACKET).add("query", _MESSAGE).add("response", _MESSAGE)
    .add("role", "string").add("rtt_nanos", "long").add("rtt_valid", "boolean").add("transaction_key", "string").add("client_ip", "string").add("client_port", "integer")
    .add("server_ip", "string").add("service_role", "string").add("parser_warnings", T.ArrayType(flat("code:string,field_path:string")))
))


def _bits(kind: T.DataType) -> int:
    return {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32}.get(type(kind), 64)


def _varint(v: int) -> bytes:
    """Groups of 7 bits, the lowest first; negative numbers take ten bytes."""
    if 0 <= v < 128:
        return bytes((v,))
    v, out = v & 0xFFFFFFFFFFFFFFFF, bytearray()
    while v > 127:
        out.append(v & 127 | 128)
        v >>= 7
    out.append(v)
    return bytes(out)


def _plan(parts: list) -> list:
    """The parts in the order of their numbers, with the bytes that begin each."""
    kinds = {"number": VARINT, "flag": VARINT, "named": VARINT}
    out = [(name, how, _varint(number << 3 | kinds.get(how, DELIMITED)), _plan(inner) if how.startswith("message") else inner, number) for name, how, number, inner in parts]
    return sorted(out, key=lambda part: part[4])


_BLANK = pa.scalar(b"", pa.binary())


def _varints(v: np.ndarray, tag: bytes, keep: np.ndarray) -> pa.Array:
    """The tag and a number for each row to keep, nothing for others."""
    rest, groups, size = np.where(keep, v, np.uint64(0)), [], np.zeros(len(v), np.int64)
    while not groups or rest.any():
        size += (rest > 0) | (not groups)
        groups.append(rest.astype(np.uint8) & 127)
        rest = rest >> np.uint64(7)
    cells = np.empty((len(v), len(tag) + len(groups)), np.uint8)
    cells[:, : len(tag)] = np.frombuffer(tag, np.uint8)
    for k, group in enumerate(groups):
        cells[:, len(tag) + k] = group | np.where(size > k + 1, 128, 0).astype(np.uint8)
    size = np.where(keep, size + len(tag), 0)
    return as_array(ends(size), pa.py_buffer(cells[np.arange(cells.shape[1]) < size[:, None]]))


def _by_row(items: pa.Array, counts: np.ndarray) -> pa.Array:
    """The bytes of each row's items, which lie behind each other, as one."""
    if not len(items):
        return as_array(np.zeros(len(counts) + 1), pa.py_buffer(b""))
    at = np.frombuffer(items.buffers()[1], np.int32)[items.offset : items.offset + len(items) + 1]
    return as_array(at[ends(counts)], items.buffers()[2])


def _unsigned(v: pa.Array) -> np.ndarray:
    return v.fill_null(False if pa.types.is_boolean(v.type) else 0).cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64)


def _written(values: pa.StructArray, plan: list) -> pa.Array:
    """A batch of structs as bytes, field by field; empty for null structs."""
    parts, names = [], [f.name for f in values.type]
    present = values.is_valid().to_numpy(zero_copy_only=False)
    inside = dict(zip(names, values.flatten(), strict=True))  # null in null structs
    for name, how, tag, inner, _ in plan:
        v = inside[name]
        fine = v.is_valid().to_numpy(zero_copy_only=False)
        if how == "always":
            parts.append(_varints(np.ones(len(v), np.uint64), tag, present))
        elif how in ("number", "flag"):
            n = _unsigned(v)
            parts.append(_varints(n, tag, n != 0))
        elif how == "named":
            found = pc.index_in(v, value_set=pa.array(list(inner), v.type)).fill_null(-1).to_numpy(zero_copy_only=False)
            parts.append(_varints(np.array(list(inner.values()), np.uint64)[found], tag, fine & (found >= 0)))
        elif how in ("messages", "numbers"):
            counts, items = pc.list_value_length(v).fill_null(0).to_numpy(zero_copy_only=False), v.flatten()
            if how == "messages":
                raw, every = _written(items, inner), np.ones(len(items), bool)
                parts.append(_by_row(pc.binary_join_element_wise(_varints(_sizes(raw), tag, every), raw, _BLANK), counts))
            else:
                raw = _by_row(_varints(_unsigned(items), b"", items.is_valid().to_numpy(zero_copy_only=False)), counts)
                parts += (_varints(_sizes(raw), tag, counts > 0), raw)
        else:
            raw = _written(v, inner) if how == "message" else v.cast(pa.binary()).fill_null(b"")
            parts += (_varints(_sizes(raw), tag, fine if how in ("message", "encoded") else _sizes(raw) > 0), raw)
    return pc.binary_join_element_wise(*parts, _BLANK) if parts else _by_row(pa.array([], pa.binary()), np.zeros(len(values), np.int64))


def _sizes(raw: pa.Array) -> np.ndarray:
    return pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.uint64)


def encoded(column: str, kind: T.StructType, numbers: dict = EVENT) -> Column:
    """The struct in a column as bytes, its fields in the order of their numbers; null for a null struct.

    Fields that are null or have their kind's default (0, false, empty) take no byte; a named value without a number counts
    as such. Numbers of an array are packed. A field without a number is a KeyError. A batch is written field by field. A message
    inside may be given as its bytes.
    """
    plan = _plan(_parts(kind, numbers))

    @F.arrow_udf(T.BinaryType())
    def each(values: pa.Array) -> pa.Array:
        return pc.if_else(values.is_valid(), _written(values, plan), pa.scalar(None, pa.binary()))

    return each(F.col(column))


def _number_at(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place an unsigned number and the place behind it, -1 if it doesn't end within ten bytes; bits beyond 64 are dropped."""
    value, behind, going = np.zeros(len(at), np.uint64), np.full(len(at), -1, np.int64), np.flatnonzero(at < end)
    for i in range(10):
        byte = data[at[going] + i]
        value[going] |= (byte & 127).astype(np.uint64) << np.uint64(7 * i)
        last = byte < 128
        behind[going[last]] = at[going[last]] + i + 1
        going = going[~last]
        going = going[at[going] + i + 1 < end[going]]
        if not len(going):
            break
    return np.where(behind < 0, np.uint64(0), value), behind


def fields(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The fields of messages between ``start`` and ``end``, those of one message in order: ``row``, ``number``, ``kind``, ``value``
    of numbers, and where the bytes of others lie, ``low`` and ``high``; and how far each message could be read: its end if it is
    well-formed. Every round reads one field of all messages that have one more."""
    at, rounds = start.copy(), []
    going = np.flatnonzero(at < end)
    while len(going):
        stop = end[going]
        tag, low = _number_at(data, at[going], stop)
        kind = (tag & np.uint64(7)).astype(np.int64)
        fine = (low >= 0) & (tag >= 8) & (tag >> np.uint64(63) == 0)
        value, behind = np.zeros(len(going), np.uint64), np.where(kind == FIXED64, low + 8, low + 4)
        sized = fine & ((kind == VARINT) | (kind == DELIMITED))
        value[sized], low[sized] = _number_at(data, low[sized], stop[sized])
        left = np.maximum(stop - low, 0).astype(np.uint64)
        fine &= np.where(sized, (low >= 0) & ((kind == VARINT) | (value <= left)), ((kind == FIXED64) | (kind == FIXED32)) & (behind <= stop))
        behind = np.where(sized, low + np.where(fine & (kind == DELIMITED), value, np.uint64(0)).astype(np.int64), behind)
        rounds.append([x[fine] for x in (going, tag >> np.uint64(3), kind, value, low, behind)])
        going, behind = going[fine], behind[fine]
        at[going] = behind
        going = going[behind < end[going]]
    none = [np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.uint64, np.int64, np.int64)]
    return dict(zip(("row", "number", "kind", "value", "low", "high"), map(np.concatenate, zip(none, *rounds, strict=True)), strict=True)), at


def _packed(data: np.ndarray, found: dict[str, np.ndarray], mine: np.ndarray, rows: int, bits: int) -> list[list[int]]:
    """Each row's numbers: those in packed fields, then those in fields of their own."""
    out: list[list[int]] = [[] for _ in range(rows)]
    packed = mine[found["kind"][mine] == DELIMITED]
    at, stop, row = found["low"][packed], found["high"][packed], found["row"][packed]
    while len(at):
        value, behind = _number_at(data, at, stop)
        for r, v in zip(row[behind >= 0].tolist(), value[behind >= 0].tolist(), strict=True):
            out[r].append(v)
        more = (behind >= 0) & (behind < stop)
        at, stop, row = behind[more], stop[more], row[more]
    for i in mine[found["kind"][mine] == VARINT].tolist():
        out[found["row"][i]].append(int(found["value"][i]))
    return [[_signed(v, bits) for v in row] for row in out]


def _signed(v: int, bits: int = 64) -> int:
    v &= (1 << bits) - 1
    return v - (1 << bits) if v >> bits - 1 else v


def _read(data: np.ndarray, start: np.ndarray, end: np.ndarray, parts: list, kind: pa.StructType, absent: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray]:
    """Messages as a batch of structs, null where ``absent``, and how far each could be read."""
    found, at = fields(data, start, end)
    out, n = [], len(start)
    for (name, how, number, inner), field in zip(parts, kind, strict=True):
        mine = np.flatnonzero(found["number"] == number)
        if how == "messages":
            items = mine[found["kind"][mine] == DELIMITED]
            items = items[np.argsort(found["row"][items], kind="stable")]
            value, _ = _read(data, found["low"][items], found["high"][items], inner, field.type.value_type)
            offsets = ends(np.bincount(found["row"][items], minlength=n)).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(offsets), value, type=field.type))
            continue
        if how == "numbers":
            out.append(pa.array(_packed(data, found, mine, n, inner["bits"]), field.type))
            continue
        last = np.full(n, -1, np.int64)
        last[found["row"][mine]] = mine  # the last of several stays
        wanted = VARINT if how in ("number", "flag", "named") else DELIMITED
        last = np.where((last >= 0) & (np.append(found["kind"], -1)[last] == wanted), last, -1)
        if wanted == VARINT:
            v = np.append(found["value"], np.uint64(0))[last]
            if how == "named":
                keys = np.array(sorted(inner), np.uint64)
                place = np.minimum(np.searchsorted(keys, v), len(keys) - 1)
                out.append(pa.array([inner[k] for k in sorted(inner)], field.type).take(pa.array(place, mask=keys[place] != v)))
            else:
                out.append(pa.array(v != 0 if how == "flag" else v.astype(f"uint{inner['bits']}").view(f"int{inner['bits']}"), field.type))
            continue
        low, high = (np.append(found[side], 0)[last] for side in ("low", "high"))
        if how == "message":
            out.append(_read(data, low, high, inner, field.type, last < 0)[0])
        else:
            out.append(taken(data, low, high, field.type))
    return pa.StructArray.from_arrays(out, fields=list(kind), mask=None if absent is None else pa.array(absent)), at


def _by_number(parts: list) -> list:
    """The parts with the names of named values by their numbers."""
    return [(name, how, number, _by_number(inner) if how.startswith("message") else {n: text for text, n in inner.items()} if how == "named" else inner) for name, how, number, inner in parts]


def walked(raw: str) -> Column:
    """``at``: how far the message in a column could be read, which is its size if it is well-formed."""
    return _decoded(T.StructType(), {})(F.expr(raw))


def _decoded(kind: T.StructType, numbers: dict, once: bool = False) -> Callable[[Column], Column]:
    """Bytes to (at, value): how far they could be read, and what was read. With ``once`` it isn't deterministic by name, so that a
    condition on it isn't moved below, where it would be decoded again."""
    parts, result = _by_number(_parts(kind, numbers)), T.StructType().add("at", "integer").add("value", kind)
    if not parts:
        result = T.StructType().add("at", "integer")
    made = to_arrow_type(result)

    @F.arrow_udf(result)
    def each(raw: pa.Array) -> pa.Array:
        data, start, end, absent = laid(raw)
        if not parts:
            return pa.StructArray.from_arrays([pa.array((fields(data, start, end)[1] - start).astype(np.int32))], fields=list(made), mask=pa.array(absent))
        value, at = _read(data, start, end, parts, made.field("value").type, absent)
        return pa.StructArray.from_arrays([pa.array((at - start).astype(np.int32)), value], fields=list(made), mask=pa.array(absent))

    return each.asNondeterministic() if once else each


def decode(rows: DataFrame, payload: str, kind: T.StructType, to: str, numbers: dict = EVENT) -> DataFrame:
    """``rows`` with the bytes in ``payload`` as a struct of the given type in ``to``; null for null bytes.

    Fields come in any order; of one that comes again the last counts; numbers that the type doesn't have, and values of
    another kind than its, are passed over. What isn't there has the default of its kind: 0, false, empty, and null for
    structs and named values. Of malformed bytes the fields before the fault are read. A batch is read field by field.
    """
    return rows.select(*[c for c in rows.columns if c != to], _decoded(kind, numbers)(F.col(payload))["value"].alias(to))


_HEADER = list(MESSAGE["header"][1])
_EDNS = flat("udp_size:int,extended_rcode:int,version:int,do_bit:boolean").add("options", T.ArrayType(flat("code:int,length:int,value:binary")))
#: A decoded message in the shape of an event's, with the decoder's names.
_SHOWN = (
    T.StructType([T.StructField("header", T.StructType([dns.MESSAGE[c] for c in _HEADER])), *[dns.MESSAGE[c] for c in ("questions", "answers", "authority", "additional")], T.StructField("edns", _EDNS)])
    .add("raw_dns_payload", "binary")
)
_RECORD = {"name": 1, "type": 2, "type_name": 3, "class": 4, "ttl": 5, "rdata": 6, "text": 7, "malformed": 8}
_NUMBERS = MESSAGE | {"answers": (3, _RECORD), "authority": (4, _RECORD), "additional": (5, _RECORD), "edns": (6, {"udp_size": 1, "extended_rcode": 2, "version": 3, "do_bit": 4, "options": (5, {"code": 1, "length": 3, "value": 4})})}
#: What of a decoded message its transaction goes by.
_SLIM = ("id", "qr", "rcode", "questions", "warnings")


def _shown(m: pa.StructArray, raw: pa.Array) -> pa.StructArray:
    """Decoded messages (``dns.parsed_batch``) and their bytes, as an event shows them."""
    made = to_arrow_type(_SHOWN)
    inside = dict(zip([f.name for f in m.type], m.flatten(), strict=True))
    edns = dict(zip([f.name for f in inside["edns"].type], inside["edns"].flatten(), strict=True))
    code, value = edns["options"].flatten().flatten()
    kind = made.field("edns").type
    option = pa.StructArray.from_arrays([code, pc.binary_length(value), value], fields=list(kind.field("options").type.value_type))
    counts = pc.list_value_length(edns["options"]).fill_null(0).to_numpy(zero_copy_only=False)
    edns["options"] = pa.ListArray.from_arrays(pa.array(ends(counts).astype(np.int32)), option, type=kind.field("options").type)
    inside["edns"] = pa.StructArray.from_arrays([edns[f.name] for f in kind], fields=list(kind), mask=inside["edns"].is_null())
    inside["header"] = pa.StructArray.from_arrays([inside[c] for c in _HEADER], fields=list(made.field("header").type))
    inside["raw_dns_payload"] = raw
    return pa.StructArray.from_arrays([inside[f.name] for f in made], fields=list(made), mask=m.is_null())


def _with(values: pa.StructArray, **other: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays([other.get(f.name, values.field(f.name)) for f in values.type], fields=list(values.type), mask=values.is_null())


def packed(packets: DataFrame) -> DataFrame:
    """Decapsulated packets (packet, src_ip, dst_ip, message) with what their transaction goes by in ``m``, null where there is no
    message, and ``packet`` (with these addresses) and ``message`` as the bytes that they are in an event: one pass, and a few
    columns to shuffle for some hundred.
    The same as decoding (:func:`wirelens.operators.events.dns_messages`) and encoding the whole event later. It isn't
    deterministic by name, so that a condition on ``m`` isn't moved below, where it would be decoded again."""
    slim = T.StructType([dns.MESSAGE[c] for c in _SLIM])
    result = T.StructType().add("m", slim).add("packet", "binary").add("message", "binary")
    made, packet_plan, plan = to_arrow_type(result), _plan(_parts(packets.schema["packet"].dataType, PACKET)), _plan(_parts(_SHOWN, _NUMBERS))

    @F.arrow_udf(result)
    def each(packet: pa.Array, src_ip: pa.Array, dst_ip: pa.Array, message: pa.Array) -> pa.Array:
        m = dns.parsed_batch(message)
        packet = _with(packet, network=_with(packet.field("network"), src_ip=src_ip, dst_ip=dst_ip))
        none = pa.scalar(None, pa.binary())
        raw = [pc.if_else(v.is_valid(), _written(v, p), none) for v, p in ((packet, packet_plan), (_shown(m, message), plan))]
        kept = pa.StructArray.from_arrays([m.field(c) for c in _SLIM], fields=list(made.field("m").type), mask=m.is_null())
        return pa.StructArray.from_arrays([kept, *raw], fields=list(made))

    rest = [c for c in packets.columns if c not in ("m", "packet", "message")]
    return packets.select(*rest, each.asNondeterministic()("packet", "src_ip", "dst_ip", "message").alias("_made")).select(*rest, "_made.*")


def _cut(plan: list) -> list:
    """The plan of an event without its raw payloads, which says so."""
    out = []
    for name, how, tag, inner, number in plan:
        if name != "raw_dns_payload":
            out.append((name, "always" if name == "raw_payload_truncated" else how, tag, _cut(inner) if how.startswith("message") else inner, number))
    return out


def entries(events: DataFrame, largest: int = LARGEST, kind: T.StructType | None = None) -> DataFrame:
    """DNS ``events`` as a stream's entries, a stored table: event_id, stream, schema, encoding, payload_kind, payload, truncated.

    An event of more than ``largest`` bytes loses its raw payloads and says so; one that is still longer is left out.
    Each is encoded once, those too long twice. ``kind`` is that of whole events, where messages inside are given as bytes.
    """
    own, result = events.schema["event"].dataType, T.StructType().add("payload", "binary").add("truncated", "boolean")
    parts = _parts(kind or own, EVENT)
    plan, shorter, by_number, made, whole_kind = _plan(_parts(own, EVENT)), _cut(_plan(parts)), _by_number(parts), to_arrow_type(result), to_arrow_type(kind or own)

    @F.arrow_udf(result)
    def each(values: pa.Array) -> pa.Array:
        raw = _written(values, plan)
        long = pc.greater(pc.binary_length(raw), largest)
        if pc.any(long).as_py():
            less = _written(_read(*laid(raw.filter(long))[:3], by_number, whole_kind)[0], shorter)
            raw = pc.replace_with_mask(raw, long, pc.if_else(pc.greater(pc.binary_length(less), largest), pa.scalar(None, pa.binary()), less))
        return pa.StructArray.from_arrays([raw, long], fields=list(made))

    found = events.select(
        F.col("event.envelope.event_id").alias("event_id"), F.col("event.envelope.stream_name").alias("stream"), F.lit(delivery.SCHEMA).alias("schema"),
        F.lit(delivery.ENCODING).alias("encoding"), F.lit("dns_transaction").alias("payload_kind"), each(F.col("event")).alias("_made"),
    ).select("event_id", "stream", "schema", "encoding", "payload_kind", "_made.payload", "_made.truncated")
    # stored, as a condition on the bytes would be moved below and encode again
    whole = stored(found, "entries")
    return whole.where("NOT truncated").unionByName(whole.where("truncated AND payload IS NOT NULL"))


def opened(rows: DataFrame, kind: T.StructType, once: bool = False) -> DataFrame:
    """``rows`` of entries with ``event``, decoded as ``kind``, and ``error``: why it can't be (its encoding, schema or kind, or
    bytes that aren't well-formed). ``once`` is for conditions on ``error``, which would else be moved below and decode twice."""
    whole = rows.withColumn("_read", _decoded(kind, EVENT, once)(F.col("payload")))
    cut = F.when(F.coalesce(F.col("_read.at") < F.octet_length("payload"), F.lit(True)), "bytes")
    checked = whole.withColumn("error", F.coalesce(delivery.rejection(), cut))
    return checked.withColumn("event", F.when(F.col("error").isNull(), F.col("_read.value"))).drop("_read")
