"""Reading the roster: who lists whom, from a database view or from files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinweave import schemas

# Fixed value: the subscription state of a confirmed friendship.
CONFIRMED_SUB = 3
CELLS = 4096  # of the key that a database counts at a time


def read_roster_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ROSTER).parquet(path)


def jdbc_max_roster_id(spark: SparkSession, url: str, view: str, properties: dict[str, str],
                       quote: str = "") -> int | None:
    """Largest rosterID of the unfiltered view, None when the view is empty."""
    probe = f"(SELECT MAX({quote}rosterID{quote}) AS top_id FROM {view}) top_row"
    return spark.read.jdbc(url, probe, properties=properties).first()[0]


def _confirmed(view: str, quote: str) -> str:
    """The confirmed rows of a view as a subquery.

    The database does the filtering and the column choice, so its own collation decides
    whether ``username`` and ``loginAccount`` are the same account.
    """
    def name(column):
        return f"{quote}{column}{quote}"

    return (
        f"(SELECT {name('rosterID')} AS {name('rosterId')}, {name('username')}, {name('loginAccount')}, "
        f"{name('userID')} AS {name('userId')} FROM {view} "
        f"WHERE {name('sub')} = {CONFIRMED_SUB} AND {name('userID')} IS NOT NULL "
        f"AND {name('username')} <> {name('loginAccount')}) confirmed"
    )


def read_relation_jdbc(spark: SparkSession, url: str, view: str, properties: dict[str, str],
                       partitions: int, quote: str = "") -> DataFrame:
    """Confirmed friendships of a roster view, read in ``partitions`` equal ranges of rosterID.

    ``quote`` is the identifier quote for databases that fold the case of bare names. Where rosterID has
    gaps or runs, ``read_relation_jdbc_balanced`` reads ranges of equal numbers of rows.
    """
    confirmed = _confirmed(view, quote)
    top = jdbc_max_roster_id(spark, url, view, properties, quote)
    if top is None or top <= 1:
        rows = spark.read.jdbc(url, confirmed, properties=properties)
    else:
        rows = spark.read.jdbc(url, confirmed, column="rosterId", lowerBound=1, upperBound=top,
                               numPartitions=partitions, properties=properties)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RELATION])


def read_relation_jdbc_balanced(spark: SparkSession, url: str, view: str, properties: dict[str, str],
                                partitions: int, quote: str = "", cells: int = CELLS) -> DataFrame:
    """As ``read_relation_jdbc``, in ranges that hold about as many rows each, whatever gaps rosterID has."""
    predicates = balanced_predicates(spark, url, view, properties, partitions, quote, cells)
    rows = spark.read.jdbc(url, _confirmed(view, quote), predicates=predicates, properties=properties)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RELATION])


def balanced_predicates(spark: SparkSession, url: str, view: str, properties: dict[str, str],
                        partitions: int, quote: str = "", cells: int = CELLS) -> list[str]:
    """Conditions on rosterId that part the confirmed rows into ranges of at most 1 / ``partitions`` of them.

    The database counts the rows of equal cells of the key; a cell with more rows than a partition may have is counted in
    cells of its own, and so on. Each count gives at most ``cells`` rows, and a round counts at most ``partitions``
    cells again. There are at most twice as many ranges as partitions asked for. Every row is in one of them: the outer
    ones are open, and rows without a key are in the first.
    """
    key, confirmed = f"{quote}rosterId{quote}", _confirmed(view, quote)

    def ask(query):
        return spark.read.jdbc(url, f"({query}) counted", properties=properties).collect()

    low, high, total = ask(f"SELECT MIN({key}) AS low_id, MAX({key}) AS high_id, COUNT({key}) AS n_rows FROM {confirmed}")[0]
    if not total:
        return ["1 = 1"]
    most = -(-int(total) // partitions)
    done, waiting = [], [(int(low), int(high) + 1, int(total))]
    while waiting:
        first, end, n = waiting.pop()
        if n <= most or end - first == 1:
            done.append((first, n))
            continue
        width = -(-(end - first) // cells)
        cell = f"FLOOR(({key} - {first}) / {width})"
        for number, rows in ask(f"SELECT {cell} AS cell_no, COUNT(*) AS n_rows FROM {confirmed} "
                                f"WHERE {key} >= {first} AND {key} < {end} GROUP BY {cell}"):
            begin = first + int(number) * width
            waiting.append((begin, min(end, begin + width), int(rows)))
    bounds, held = [], 0
    for first, n in sorted(done):
        if held and held + n > most:
            bounds.append(first)
            held = 0
        held += n
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {bounds[0]} OR {key} IS NULL", *inner, f"{key} >= {bounds[-1]}"]
