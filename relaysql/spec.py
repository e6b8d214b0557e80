"""Job configuration.

A job is the 12 values the original command line took, in this order: master,
batch interval in seconds, app name, input servers, output servers, input
topic, output topic, consumer group, input schema, output schema, function
config, SQL. :meth:`JobSpec.from_args` takes exactly those 12 strings; any other
count is an error rather than a silent fall-back to built-in defaults.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from relaysql.functions.registry import FunctionSpec, parse_function_config
from relaysql.operators.decode import BAD_RECORD_POLICIES
from relaysql.operators.schema import Field, parse_schema_spec

ARG_NAMES = (
    "master", "interval_seconds", "app_name", "in_servers", "out_servers", "in_topic",
    "out_topic", "group_id", "input_schema", "output_schema", "functions", "sql",
)

DEFAULT_APP_NAME = "relaysql-job"

# The sample job the original ran with no arguments.
SAMPLE_TOPICS = {"in_topic": "stu", "out_topic": "stu_clean", "group_id": "g1"}
SAMPLE_INPUT_SCHEMA = '{"name":"string","age":"int","favors":"array<string>"}'
SAMPLE_OUTPUT_SCHEMA = '{"newname":"string","age":"int","favors":"array<string>"}'
SAMPLE_FUNCTIONS = (
    '[{"name":"m1","mainClass":"relaysql.functions.library:suffix_new",'
    '"param":"(String)","returnType":"string"}]'
)
# The same with the pooled lookup; the store is a view of two columns.
SAMPLE_LOOKUP_FUNCTIONS = (
    '[{"name":"m1","mainClass":"relaysql.functions.lookup:const_lookup","param":"(String)","returnType":"string",'
    '"options":{"view":"kv","key_col":"k","value_col":"v","key":"k1","style":"pooled"}}]'
)
SAMPLE_SQL = "select m1(name) as newname,age,favors from source"


class JobSpecError(ValueError):
    """The job configuration is invalid."""


@dataclass(frozen=True)
class JobSpec:
    input_schema: str
    output_schema: str
    sql: str
    functions: str = ""
    app_name: str = DEFAULT_APP_NAME
    master: str | None = None
    interval_seconds: int = 5
    in_servers: str = ""
    out_servers: str = ""
    in_topic: str = ""
    out_topic: str = ""
    group_id: str = ""
    unknown_types: str = "string"
    on_bad_record: str = "fail"
    extra_conf: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        if not self.sql or not self.sql.strip():
            raise JobSpecError("sql is empty")
        if self.interval_seconds <= 0:
            raise JobSpecError("interval_seconds must be positive")
        if self.on_bad_record not in BAD_RECORD_POLICIES:
            raise JobSpecError(f"on_bad_record must be one of {BAD_RECORD_POLICIES}")
        # parse eagerly so a bad spec fails at configuration time
        _ = self.input_fields, self.output_fields, self.function_specs

    @classmethod
    def from_args(cls, args: Sequence[str], **options) -> JobSpec:
        if len(args) != len(ARG_NAMES):
            raise JobSpecError(f"expected {len(ARG_NAMES)} arguments ({', '.join(ARG_NAMES)}), got {len(args)}")
        values = dict(zip(ARG_NAMES, args))
        try:
            values["interval_seconds"] = int(values["interval_seconds"])
        except ValueError as e:
            raise JobSpecError(f"interval_seconds is not an integer: {values['interval_seconds']!r}") from e
        return cls(**values, **options)

    @classmethod
    def sample(cls, lookup: bool = False, **overrides) -> JobSpec:
        """The sample job; ``lookup``: with the pooled lookup, whose store is the
        reference view ``kv`` (k, v)."""
        values = dict(input_schema=SAMPLE_INPUT_SCHEMA, output_schema=SAMPLE_OUTPUT_SCHEMA,
                      functions=SAMPLE_LOOKUP_FUNCTIONS if lookup else SAMPLE_FUNCTIONS, sql=SAMPLE_SQL, **SAMPLE_TOPICS)
        values.update(overrides)
        return cls(**values)

    @cached_property
    def input_fields(self) -> tuple[Field, ...]:
        return parse_schema_spec(self.input_schema, self.unknown_types)

    @cached_property
    def output_fields(self) -> tuple[Field, ...]:
        """Declared output fields; empty when no output schema is given, in which
        case every SQL result column is published as it is."""
        if isinstance(self.output_schema, str) and not self.output_schema.strip():
            return ()
        return parse_schema_spec(self.output_schema, self.unknown_types)

    @cached_property
    def function_specs(self) -> tuple[FunctionSpec, ...]:
        return parse_function_config(self.functions)
