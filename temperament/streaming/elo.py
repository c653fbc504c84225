"""Elo ratings that are kept up to date while games arrive, in any order.

The state of a run is its ratings, the number of the next game, and the games that came too early. A game is played
once all games before it have been: early ones wait in the state, on disk and packed by blocks of numbers, until the gap closes. So the ratings are those of
the games in order, however they arrive. One run is one key; as every game depends on the one before, a run is
inherently sequential, and the work spreads over the runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from temperament.fixed_values import ELO_K, ELO_SCALE, ELO_START

RATED = "run string, trait string, rating double, after bigint"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
GAMES = pa.schema([("seq", pa.int64()), ("trait_1", pa.string()), ("trait_2", pa.string()), ("winner", pa.string())])
#: Early games are stored together by blocks of so many consecutive numbers; what is asked of the state goes with blocks, not games.
BLOCK = 1 << 16
#: Arrived games of a run that are handled together.
HELD = 1 << 18


def _packed(games: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, GAMES) as writer:
        writer.write_table(games)
    return sink.getvalue().to_pybytes()


def _distinct(games: pa.Table, first: int) -> pa.Table:
    """The games from number `first` on in order; of a number that is there several times, the first row."""
    seqs, rows = np.unique(games["seq"].to_numpy(), return_index=True)
    return games.take(pa.array(rows[seqs >= first]))


def _held(frames: Iterator[pd.DataFrame]) -> Iterator[pa.Table]:
    """The arrived games, a bounded number at a time; those without a number are left out."""
    held, count = [], 0
    for frame in frames:
        frame = frame[frame["seq"].notna()].astype({"seq": "int64"})
        held.append(pa.Table.from_pandas(frame[GAMES.names], GAMES, preserve_index=False))
        count += len(frame)
        if count >= HELD:
            yield pa.concat_tables(held)
            held, count = [], 0
    if count:
        yield pa.concat_tables(held)


class _Run(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "seq bigint")
        self.ratings = handle.getMapState("ratings", "trait string", "rating double")
        self.parts = handle.getMapState("parts", "block bigint", "parts bigint")
        self.early = handle.getMapState("early", "block bigint, part bigint", "games binary")

    def keep(self, block: int, games: pa.Table) -> None:
        part = self.parts.getValue((block,))[0] if self.parts.containsKey((block,)) else 0
        self.early.updateValue((block, part), (_packed(games),))
        self.parts.updateValue((block,), (part + 1,))

    def taken(self, block: int) -> list[pa.Table]:
        """The stored games of a block, which leave the state."""
        if not self.parts.containsKey((block,)):
            return []
        keys = [(block, part) for part in range(self.parts.getValue((block,))[0])]
        games = [pa.ipc.open_stream(bytes(self.early.getValue(key)[0])).read_all() for key in keys]
        for key in keys:
            self.early.removeKey(key)
        self.parts.removeKey((block,))
        return games

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number = self.next.get()[0] if self.next.exists() else 0
        changed: dict[str, float] = {}

        def rating(trait: str) -> float:
            if trait not in changed:
                stored = self.ratings.getValue((trait,))
                changed[trait] = stored[0] if stored else ELO_START
            return changed[trait]

        def play(games: pa.Table) -> None:
            for one, two, winner in zip(*(games[c].to_pylist() for c in ("trait_1", "trait_2", "winner"))):
                if winner is None or one is None or two is None or winner not in (one, two):
                    continue
                a, b = rating(one), rating(two)
                gain = ELO_K * ((winner == one) - 1.0 / (1.0 + 10.0 ** ((b - a) / ELO_SCALE)))
                # a trait against itself ends where it was
                changed[one] += gain
                changed[two] -= gain

        for arrived in _held(rows):
            games = _distinct(arrived, number)  # earlier ones have been played already
            seqs = games["seq"].to_numpy()
            if not len(seqs):
                continue
            blocks = seqs // BLOCK
            starts = np.flatnonzero(np.diff(blocks, prepend=-1))
            pieces = {int(blocks[a]): games.slice(a, b - a) for a, b in zip(starts, [*starts[1:], len(seqs)])}
            open_up = seqs[0] == number
            while open_up:
                block = number // BLOCK
                # a stored game goes before one that arrives again
                known = self.taken(block) + ([pieces.pop(block)] if block in pieces else [])
                if not known:
                    break
                games = _distinct(pa.concat_tables(known), number)
                late = np.flatnonzero(games["seq"].to_numpy() != number + np.arange(len(games)))
                count = int(late[0]) if len(late) else len(games)
                play(games.slice(0, count))
                number += count
                if count < len(games):
                    self.keep(block, games.slice(count))
                open_up = number == (block + 1) * BLOCK
            for block, piece in pieces.items():
                self.keep(block, piece)
        self.next.update((number,))
        for trait, value in changed.items():
            self.ratings.updateValue((trait,), (value,))
        if changed:
            traits = list(changed)
            yield pd.DataFrame({"run": key[0], "trait": traits, "rating": [changed[t] for t in traits], "after": number})

    def close(self) -> None:
        pass


def online_ratings(games: DataFrame) -> DataFrame:
    """A stream of ``run, trait, rating, after`` from a stream of games: a row per trait whose rating a batch has moved.

    ``games`` has run, seq, trait_1, trait_2 and winner; ``seq`` counts the games of a run from 0 without gaps, and ``after`` is the
    number of games played so far. A game without a valid winner changes nothing. A game that arrives again is left out.
    """
    rows = games.select("run", "seq", "trait_1", "trait_2", "winner")
    return rows.groupBy("run").transformWithStateInPandas(_Run(), RATED, outputMode="Append", timeMode="None")


def rate_arriving_games(games: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Play all games that have arrived and add the moved ratings to ``output``; a later call goes on from the checkpoint."""
    conf = games.sparkSession.conf
    before = conf.get(STORE, None)
    conf.set(STORE, ROCKS)  # read when the query starts
    try:
        writer = online_ratings(games).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(availableNow=True).start()
    finally:
        conf.unset(STORE) if before is None else conf.set(STORE, before)


def latest_ratings(moved: DataFrame) -> DataFrame:
    """The rating of every trait that has played, from the rows of ``online_ratings``."""
    return moved.groupBy("run", "trait").agg(F.max_by("rating", "after").alias("rating"))
