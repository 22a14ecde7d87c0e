"""Side inputs on streams: each micro-batch sees the value that is current when it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from msgflow.operators import side_inputs as SI


def with_refreshed_side_input(
    read_table: Callable[[], DataFrame],
    name: str,
    write: Callable[[DataFrame, int], None],
    *,
    column: str = "side_input",
    version: str = "side_input_version",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds the current value and its version to every row.

    ``read_table`` opens the side input table anew for each micro-batch, so rows retrieved since the
    last one count. The version in the output tells which value a row saw, also after a replay.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        write(SI.with_side_input(batch, read_table(), name, column, version), batch_id)

    return each
