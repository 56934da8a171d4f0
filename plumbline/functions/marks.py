"""Sets of elements as numbers, an element a bit, so that sets combine before a shuffle."""

from pyspark.sql import DataFrame, functions as F

from plumbline.sources.local import text_frame


WORD = 63  # elements in one number of marks


def element_marks(elements: DataFrame) -> tuple[DataFrame, int]:
    """Elements by number: the place of each one's mark (``_word``, ``_bit``), and how many words there are.

    As long as the elements of the forms, which are rule rows.
    """
    ids = sorted(r["source_id"] for r in elements.select("source_id").distinct().collect() if r["source_id"] is not None)
    places = [(s, str(i // WORD), str(1 << i % WORD)) for i, s in enumerate(ids)]
    marks = text_frame(elements.sparkSession, places, ("source_id", "_word", "_bit"))
    return marks.withColumns({"_word": F.col("_word").cast("int"), "_bit": F.col("_bit").cast("bigint")}), max(
        1, -(-len(ids) // WORD))
