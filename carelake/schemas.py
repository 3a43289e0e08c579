"""Record schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "counts": T.MapType(T.StringType(), T.LongType()),
}


def record(**fields: str) -> T.StructType:
    """A nullable struct from ``name=type`` pairs."""
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields.items()])


# Column names and types of the exchanged records, in their order.
# Temperatures are doubles, so that a reading of exactly the fever limit compares as equal to it.
ENCOUNTER = record(
    patient_id="string",
    cpf="string",
    nome="string",
    email="string",
    telefone="string",
    idade="int",
    sexo="string",
    cidade="string",
    estado="string",
    blood_pressure="string",
    heart_rate="int",
    temperatura="double",
    saturacao_o2="int",
    diagnostico="string",
    medicamento="string",
    timestamp="string",
)
STREAM_EVENT = record(
    patient_id="string",
    cpf="string",
    nome="string",
    blood_pressure="string",
    heart_rate="int",
    temperatura="double",
    saturacao_o2="int",
    timestamp="string",
)
STATE_PAYLOAD = record(id="int", sigla="string", nome="string").add("regiao", record(nome="string"))
SUMMARY_PAYLOAD = record(
    country="string",
    cases="bigint",
    deaths="bigint",
    recovered="bigint",
    active="bigint",
    casesPerOneMillion="double",
    deathsPerOneMillion="double",
    tests="bigint",
    population="bigint",
    updated="bigint",
)
TIMELINE_PAYLOAD = T.StructType().add("timeline", record(cases="counts", deaths="counts", recovered="counts"))

# one record per commit of a versioned table
COMMIT = record(
    version="bigint",
    base="bigint",
    timestamp="timestamp",
    operation="string",
    user_name="string",
    metrics="counts",
    columns="string",
    token="string",
)

PROGRESS = record(
    query="string",
    run="string",
    batch="bigint",
    at="timestamp",
    rows="bigint",
    newest="timestamp",
    watermark="timestamp",
)
