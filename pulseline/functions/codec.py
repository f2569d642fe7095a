"""Binary wire codec for heartbeat messages (DEC-2, DEC-3).

The JVM protobuf functions (``from_protobuf`` / ``to_protobuf``) need the
spark-protobuf package, which this deployment does not carry, so decoding and
encoding run as ``mapInArrow`` over Arrow record batches, column by column
(``wire``). Only messages in another than the declared form go one by one
through the message class that each task builds from the declared field list,
which accepts them or words the error. The task output is a struct of the
fields plus an error text, so a single pass feeds both the good rows and the
dead letters (FLT-4).
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseline.functions import wire
from pulseline.functions.parallel import spread_small_input
from pulseline.functions.scalars import millis_to_ts, normalize_device_fields, ts_to_millis
from pulseline.schemas import WIRE_FIELDS, WIRE_MESSAGE_NAME, WIRE_PACKAGE

_SPARK_TYPES = {"string": T.StringType(), "int64": T.LongType(),
                "double": T.DoubleType(), "bool": T.BooleanType()}
WIRE_SCHEMA = T.StructType([T.StructField(n, _SPARK_TYPES[k]) for n, _, k in WIRE_FIELDS])
WIRE_NAMES = [n for n, _, _ in WIRE_FIELDS]

# Task functions of this module travel by value, so executors need only
# pyspark, pyarrow and protobuf, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def build_message_class():
    """The heartbeat message class, built from the declared field list.

    Called once per task inside the Arrow functions (a descriptor pool is
    not picklable, so nothing built here is shipped from the driver).
    """
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
    fdp = descriptor_pb2.FileDescriptorProto(
        name="pulseline_heartbeat.proto", package=WIRE_PACKAGE, syntax="proto3")
    msg = fdp.message_type.add(name=WIRE_MESSAGE_NAME)
    kinds = {"string": descriptor_pb2.FieldDescriptorProto.TYPE_STRING,
             "int64": descriptor_pb2.FieldDescriptorProto.TYPE_INT64,
             "double": descriptor_pb2.FieldDescriptorProto.TYPE_DOUBLE,
             "bool": descriptor_pb2.FieldDescriptorProto.TYPE_BOOL}
    for name, number, kind in WIRE_FIELDS:
        msg.field.add(name=name, number=number, type=kinds[kind],
                      label=descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL)
    pool = descriptor_pool.DescriptorPool()
    pool.Add(fdp)
    return message_factory.GetMessageClass(
        pool.FindMessageTypeByName(f"{WIRE_PACKAGE}.{WIRE_MESSAGE_NAME}"))


def message_class():
    """Driver-side helper (tests, tools): a freshly built message class."""
    return build_message_class()


def decode_binary(df: DataFrame, payload_col: str = "value", spread: bool = False) -> DataFrame:
    """Decode the binary column into the 12 wire fields (DEC-2).

    Output: the input columns, the wire fields (proto3 defaults for absent
    fields, as the reference's getters return), ``ts`` (FN-1) and
    ``decode_error`` (null when the payload decoded; a null payload fails,
    an empty payload is a valid all-default message). ``spread=True``
    first gives a small scanned input one partition per core
    (``spread_small_input``).
    """
    import pyarrow as pa

    keep = [c for c in df.columns]
    in_schema = df.schema
    out_schema = T.StructType(list(in_schema.fields) + list(WIRE_SCHEMA.fields)
                              + [T.StructField("decode_error", T.StringType())])
    pa_types = {"string": pa.string(), "int64": pa.int64(),
                "double": pa.float64(), "bool": pa.bool_()}
    fields = list(WIRE_FIELDS)

    def decode_batches(batches):
        cls = build_message_class()
        for batch in batches:
            payloads = batch.column(payload_col)
            columns, odd = wire.parse(payloads)
            absent = payloads.is_null().to_numpy(zero_copy_only=False)
            rest = (odd | absent).nonzero()[0].tolist()
            errors = [None] * len(payloads)
            if rest:  # decided by the message class
                values = {name: [] for name, _, _ in fields}
                for i in rest:
                    message = None
                    try:
                        if absent[i]:
                            errors[i] = "null payload"
                        else:
                            message = cls.FromString(payloads[i].as_py())
                    except Exception as exc:  # DecodeError and friends
                        errors[i] = type(exc).__name__ + ": " + str(exc)
                    for name in values:
                        values[name].append(None if message is None else getattr(message, name))
                place = list(range(len(payloads)))
                for k, i in enumerate(rest):
                    place[i] = len(payloads) + k
                place = pa.array(place, pa.int64())
                columns = [pa.concat_arrays([column, pa.array(values[name], pa_types[kind])]).take(place)
                           for column, (name, _, kind) in zip(columns, fields)]
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, *columns, pa.array(errors, pa.string())],
                names=keep + [name for name, _, _ in fields] + ["decode_error"])

    src = spread_small_input(df) if spread else df
    decoded = src.mapInArrow(decode_batches, out_schema)
    return decoded.withColumn("ts", millis_to_ts("timestamp_ms"))


def encode_binary(df: DataFrame, out_col: str = "value", spread: bool = False,
                  keep: list[str] | None = None) -> DataFrame:
    """Serialise heartbeat rows to the binary message (DEC-3).

    Event time goes to whole epoch milliseconds (FN-2) and absent device
    strings to "" (FN-3) in Spark, before the Arrow hand-off; the task only
    serialises. Output: the input columns (of them those named by ``keep``,
    if given: the others then take no way back from the task) plus ``out_col``.
    """
    import pyarrow as pa

    prepared = normalize_device_fields(df).withColumn("__wire_ms", ts_to_millis("ts"))
    source = ["__wire_ms" if name == "timestamp_ms" else name for name, _, _ in WIRE_FIELDS]
    kept = list(prepared.columns if keep is None else keep)
    prepared = prepared.select(*[c for c in prepared.columns if c in kept or c in source])
    out_schema = T.StructType([prepared.schema[c] for c in kept] + [T.StructField(out_col, T.BinaryType())])

    def encode_batches(batches):
        for batch in batches:
            values = wire.write([batch.column(name) for name in source])
            arrays = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*arrays, values], names=kept + [out_col])

    src = spread_small_input(prepared) if spread else prepared
    return src.mapInArrow(encode_batches, out_schema).drop("__wire_ms")


def split_decoded(decoded: DataFrame):
    """(good, failed) halves of one decode result (FLT-4, SET-2); disjoint and complete."""
    return (decoded.filter(F.col("decode_error").isNull()),
            decoded.filter(F.col("decode_error").isNotNull()))
