"""Message arrays: building, rewriting, rendering and truncating chat transcripts."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from temperament.functions.text import as_column, last_tokens, token_count


def message(role, content) -> Column:
    return F.struct(as_column(role).alias("role"), as_column(content).alias("content"))


def messages(*turns: tuple) -> Column:
    """Message array from ``(role, content)`` couples; strings are literals, columns are columns."""
    return F.array(*[message(role, content) for role, content in turns])


def exchange(prompt: Column, reply: Column) -> Column:
    return messages(("user", prompt), ("assistant", reply))


def replace_system(transcript: Column, system, *, strict: bool = True) -> Column:
    """Overwrite the first message when it is the system prompt.

    ``strict`` raises on a transcript that does not start with one; otherwise it is left alone.
    """
    first_is_system = F.coalesce(F.get(transcript, F.lit(0))["role"] == "system", F.lit(False))
    replaced = F.concat(
        F.array(message("system", system)),
        F.slice(transcript, F.lit(2), F.greatest(F.size(transcript) - 1, F.lit(0))),
    )
    if strict:
        failure = F.raise_error(F.lit("transcript does not start with a system message"))
        return F.when(first_is_system, replaced).otherwise(
            failure.cast("array<struct<role:string,content:string>>")
        )
    return F.when(first_is_system, replaced).otherwise(transcript)


def openings(system: Column, greeting_1: Column, greeting_2: Column) -> tuple[Column, Column]:
    """The two sides' starting contexts of a self-dialogue."""
    one = messages(("system", system), ("user", greeting_1))
    two = messages(("system", system), ("user", greeting_2), ("assistant", greeting_1))
    return one, two


def dialogue_view(conversation: Column, side_1: Column, side_2: Column) -> Column:
    """The transcript as the side about to speak sees it.

    With an even number of replies the first side speaks next, otherwise the second; either way the
    replies alternate so that the last message comes from the user.
    """
    even = F.size(conversation) % 2 == 0
    replies = F.transform(
        conversation,
        lambda reply, place: F.struct(
            F.when((F.size(conversation) - place) % 2 == 1, F.lit("user"))
            .otherwise(F.lit("assistant"))
            .alias("role"),
            reply.alias("content"),
        ),
    )
    return F.concat(F.when(even, side_1).otherwise(side_2), replies)


def with_suffix(question: Column, suffix: Column) -> Column:
    """The suffix on a line of its own below the question; a null suffix leaves the question."""
    return F.concat_ws("\n", question, suffix)


@dataclass(frozen=True)
class ChatTemplate:
    """How one model family writes a transcript as a single string."""

    before_role: str
    after_role: str
    after_content: str
    start: str = ""
    roles: dict = field(default_factory=dict)

    def render(self, transcript: Column, *, invite: bool = True) -> Column:
        """One string for the transcript; ``invite`` appends the opening of an assistant turn.

        A turn without content is written as an empty one.
        """

        text = F.concat(F.lit(self.start), F.array_join(F.transform(transcript, lambda turn: self.one(turn["role"], turn["content"])), ""))
        return F.concat(text, F.lit(self.invitation)) if invite else text

    def one(self, role: Column, content: Column) -> Column:
        """A single turn as it is written."""
        return F.concat(
            F.lit(self.before_role),
            self._role(role),
            F.lit(self.after_role),
            F.coalesce(content, F.lit("")),
            F.lit(self.after_content),
        )

    @property
    def keeps_tokens_apart(self) -> bool:
        """Whether no token of the default counter can span a part of the template and what stands next to it."""

        def is_word(letter: str) -> bool:
            return letter == "_" or unicodedata.category(letter)[0] in "LMN"

        parts = (self.before_role, self.after_role, self.after_content)
        edges = [p[0] for p in parts if p] + [p[-1] for p in (*parts, self.start) if p]
        return all(parts) and not any(map(is_word, edges))

    @property
    def invitation(self) -> str:
        return self.before_role + self.roles.get("assistant", "assistant") + self.after_role

    def _role(self, role: Column) -> Column:
        for name, shown in self.roles.items():
            role = F.when(role == name, F.lit(shown)).otherwise(role)
        return role


# Published chat formats of the model families the data is prepared for.
CHATML = ChatTemplate("<|im_start|>", "\n", "<|im_end|>\n")
LLAMA = ChatTemplate(
    "<|start_header_id|>", "<|end_header_id|>\n\n", "<|eot_id|>", start="<|begin_of_text|>"
)
GEMMA = ChatTemplate(
    "<start_of_turn>", "\n", "<end_of_turn>\n", start="<bos>", roles={"assistant": "model"}
)
OLMO = ChatTemplate("<|", "|>\n", "\n", start="<|endoftext|>")


FAMILIES = {"llama": LLAMA, "gemma": GEMMA, "olmo": OLMO}


def template_for(model: str) -> ChatTemplate:
    return FAMILIES.get(model.split("-")[0], CHATML)


def transcript_tokens(transcript: Column, template: ChatTemplate = CHATML, counter=token_count) -> Column:
    """Token length of the rendered transcript, invitation included."""
    return counter(template.render(transcript))


def keep_last(tokens: Column, limit) -> Column:
    """The last ``limit`` elements of a token array; nothing when the limit is zero."""
    limit = as_column(limit)
    return F.slice(
        tokens,
        F.greatest(F.size(tokens) - limit + 1, F.lit(1)),
        F.least(limit, F.size(tokens)),
    )


def keep_last_tokens(text: Column, limit) -> Column:
    """Left-truncate a prompt to its last ``limit`` tokens, by the same tokens as the default counter.

    With a tokenizer of your own, pass a function that encodes, cuts and decodes in its place.
    """
    return last_tokens(text, as_column(limit))
