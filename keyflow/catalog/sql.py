"""Common parts of the comparison SQL."""

READINGS = """
    r AS (
        SELECT event_id AS seq, user_id AS id, ts, CAST(floor(value) AS INTEGER) AS vc, event_type
        FROM events
    )"""

ARRIVALS = (
    READINGS
    + """,
    a AS (SELECT *, ts + to_minutes(CAST((seq * 7919) % 97 * 3 AS INTEGER)) AS arrival FROM r)"""
)

WORDS = """
    lines AS (SELECT doc_id, replace(text, chr(10), ' ') AS value FROM documents WHERE text IS NOT NULL),
    split AS (
        SELECT doc_id,
               CASE WHEN value = '' THEN ['']
                    WHEN rtrim(value, ' ') = '' THEN []
                    ELSE string_split(rtrim(value, ' '), ' ') END AS parts
        FROM lines
    ),
    w AS (SELECT doc_id, unnest(parts) AS word, CAST(unnest(range(len(parts))) AS INTEGER) AS pos FROM split)"""

HOUR_US = 3_600_000_000


def bucket(time: str, hours: int = 1) -> str:
    """Start of the epoch-aligned window of a time."""
    width = hours * HOUR_US
    return f"make_timestamp(epoch_us({time}) // {width} * {width})"
