"""Record layouts of the payload, request, assessment and evaluation tables.

Field names and nesting are fixed values: logs written elsewhere are read with them.
"""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"
CHOICES = f"array<struct<message:{MESSAGE}>>"
CHUNK = "struct<chunk_id:string,doc_uri:string,content:string>"

TRACE_STEP = (
    "struct<step_id:string,name:string,type:string,"
    "start_timestamp:timestamp,end_timestamp:timestamp,"
    f"retrieval:struct<query_text:string,chunks:array<{CHUNK}>>,"
    "text_generation:struct<prompt:string,generated_text:string>>"
)
TRACE = (
    "struct<app_version_id:string,start_timestamp:timestamp,end_timestamp:timestamp,"
    f"is_truncated:boolean,steps:array<{TRACE_STEP}>>"
)
REQUEST = (
    "struct<request_id:string,conversation_id:string,timestamp:timestamp,"
    f"messages:{MESSAGES},last_input:string>"
)
REQUEST_LOG = f"request {REQUEST}, trace {TRACE}, output struct<choices:{CHOICES}>"

SOURCE = "struct<type:string,id:string,tags:map<string,string>>"

# As sent by the review app: one boolean per rating.
WIRE_RATINGS = "map<string,struct<value:boolean,rationale:string>>"
WIRE_TEXT = (
    f"struct<step_id:string,ratings:{WIRE_RATINGS},"
    "free_text_comment:string,suggested_output:string>"
)
WIRE_RETRIEVAL = (
    f"struct<position:int,step_id:string,ratings:{WIRE_RATINGS},free_text_comment:string>"
)
WIRE_RECORDS = (
    f"array<struct<request_id:string,step_id:string,source:{SOURCE},"
    f"text_assessments:array<{WIRE_TEXT}>,retrieval_assessments:array<{WIRE_RETRIEVAL}>>>"
)

# As stored: a rating may be boolean or numeric.
RATINGS = "map<string,struct<bool_value:boolean,double_value:double,rationale:string>>"
TEXT_ASSESSMENT = (
    f"struct<step_id:string,ratings:{RATINGS},free_text_comment:string,suggested_output:string>"
)
RETRIEVAL_ASSESSMENT = (
    f"struct<position:int,step_id:string,ratings:{RATINGS},free_text_comment:string>"
)
ASSESSMENT_LOG = (
    f"request_id string, step_id string, source {SOURCE}, timestamp timestamp, "
    f"text_assessment {TEXT_ASSESSMENT}, retrieval_assessment {RETRIEVAL_ASSESSMENT}"
)

EVAL_SET = (
    f"request_id string, request string, expected_retrieval_context array<{CHUNK}>"
)
QUESTIONS = "chunk_id string, question string, tries int, error string"
DEMO = "struct<augmented:boolean,request:string,context:string,rationale:string,response:string>"
PROGRAM = (
    f"program struct<demos:array<{DEMO}>,signature_instructions:string,signature_prefix:string>"
)


def table(ddl: str) -> T.StructType:
    """Parse one of the table layouts above."""
    return T.StructType.fromDDL(ddl)
