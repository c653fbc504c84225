"""Schemas of the stored tables. Reads name their schema; nothing is inferred."""

from pyspark.sql import types as T

TEXT = T.StringType()
MESSAGES = T.ArrayType(T.StructType([T.StructField("role", TEXT), T.StructField("content", TEXT)]))


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CONSTITUTION_FILE = _table(trait=TEXT, clarification=TEXT, questions=T.ArrayType(TEXT))
CONSTITUTION = _table(
    trait=TEXT,
    clarification=TEXT,
    questions=T.ArrayType(TEXT),
    additional_questions=T.ArrayType(TEXT),
)
ANSWERS = _table(constitution=TEXT, prompt_id=TEXT, prompt=TEXT, producer=TEXT, response=TEXT)
PAIRS = _table(chosen=MESSAGES, rejected=MESSAGES)
TRANSCRIPTS = _table(messages=MESSAGES)
REFLECTIONS = _table(prompt=TEXT, messages=MESSAGES, response=TEXT)
INTERACTIONS = _table(
    greeting_1=TEXT,
    greeting_2=TEXT,
    messages_1=MESSAGES,
    messages_2=MESSAGES,
    conversation=T.ArrayType(TEXT),
    messages=MESSAGES,
)
CHOICES = _table(messages=MESSAGES, trait_1=TEXT, trait_2=TEXT, response=TEXT)
RESPONSES = _table(question=TEXT, response=TEXT)
WIN_RATES = _table(model=TEXT, constitution=TEXT, win_rate=T.DoubleType())
SCORES = _table(method=TEXT, variant=TEXT, score=T.DoubleType())
BENCHMARK_RESULTS = _table(model=TEXT, task=TEXT, mean=T.DoubleType(), se=T.DoubleType())
FIRST_TURN_STRINGS = _table(conversations=T.ArrayType(TEXT))
FIRST_TURN_INPUTS = _table(conversation=T.ArrayType(_table(input=TEXT)))
FIRST_TURN_CONTENTS = _table(conversation=T.ArrayType(_table(content=TEXT)))
