"""Source schemas and warehouse table specs.

Every column name, type, length, key and layout below is a fixed value: input
files and existing warehouses depend on it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
FLOAT, DOUBLE, BOOLEAN = T.FloatType(), T.DoubleType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def struct(**columns: T.DataType) -> T.StructType:
    """A schema from ``name=type`` pairs; every column is nullable."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column order and types of movies_metadata.csv. CSV cells bind by
# position, so the order matters and the names need not equal the header's.
MOVIES_CSV = struct(
    adult=STRING,
    belongs_to_collection=LONG,
    budget=LONG,
    genres=STRING,
    homepage=STRING,
    id=INT,
    imdb_id=STRING,
    original_language=STRING,
    original_title=STRING,
    overview=STRING,
    popularity=DOUBLE,
    poster_path=STRING,
    production_company=STRING,
    production_country=STRING,
    release_date=DATE,
    revenue=LONG,
    runtime=FLOAT,
    spoken_languages=STRING,
    status=STRING,
    tagline=STRING,
    title=STRING,
    video=BOOLEAN,
    vote_average=FLOAT,
    vote_count=INT,
)

# Column order and types of ratings.csv.
RATINGS_CSV = struct(userId=INT, movieId=INT, rating=DOUBLE, timestamp=TIMESTAMP)

# Fixed value: the JSON text in the genres column.
GENRE_JSON = T.ArrayType(struct(id=INT, name=STRING))

# A bare NUMERIC has scale 0 in some warehouses, which would round half-star
# ratings; the default keeps them.
RATING_TYPE = T.DecimalType(3, 1)


@dataclass(frozen=True)
class TableSpec:
    """What the warehouse promises about one table.

    ``keys`` is the merge key.  ``lengths`` bounds text columns; ``pad`` names the
    fixed-width ones.  A table is either distributed by ``dist_key`` or meant to be
    whole on every node (``replicated``), and stored sorted by ``sort_by`` if given.
    ``part_key`` must be one of the keys: a merge then reads and rewrites only the folders its
    source's keys fall in.
    ``surrogate`` is a generated key that sources never carry.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    pad: tuple[str, ...] = ()
    dist_key: str | None = None
    sort_by: str | None = None
    surrogate: str | None = None
    buckets: int = 0  # of a table distributed by dist_key; 0 stores it without
    max_skew: float | None = 4.0  # of the fullest bucket to an even share; None takes any
    skew_bytes: int = 64 << 20  # a smaller bucket is never too full
    join_bytes: int = 64 << 20  # a mean bucket of more is not joined as it lies
    part_key: str | None = None  # a key column; the table is stored in folders by its ranges
    part_bytes: int = 256 << 20  # a folder of twice that is cut when it is next rewritten
    max_parts: int = 128  # a table of more than so many times part_bytes has folders of that share of it
    stage_not_null: tuple[str, ...] = ()  # further columns of a staged row

    @property
    def stage_spec(self) -> TableSpec:
        """What a staged row must hold before it is merged."""
        return replace(self, not_null=self.not_null + self.stage_not_null)

    @property
    def stage(self) -> TableSpec:
        """The staging table of this table: what a source delivers, stored as it comes."""
        return TableSpec(
            f"stage_{self.name}",
            self.stage_schema,
            not_null=self.not_null + self.stage_not_null,
            lengths=self.lengths,
            pad=self.pad,
            dist_key=self.dist_key,
        )

    @property
    def replicated(self) -> bool:
        return self.dist_key is None

    @property
    def set_cols(self) -> list[str]:
        """Columns an update overwrites: all but the keys and the surrogate."""
        return [c for c in self.schema.names if c not in self.keys and c != self.surrogate]

    @property
    def stage_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema.fields if f.name != self.surrogate])


def warehouse_specs(
    rating_type: T.DecimalType = RATING_TYPE, buckets: int = 8, part_bytes: int = 256 << 20
) -> dict[str, TableSpec]:
    """The six warehouse tables and their staging tables.

    ``buckets`` is the number a distributed table is stored in, one task each in a join; choose
    it so that a bucket fits a task.
    """
    # The six warehouse tables.
    tables = [
        TableSpec(
            "movies",
            struct(
                movie_id=INT,
                is_adult=STRING,
                original_language=STRING,
                title=STRING,
                popularity=DOUBLE,
                release_date=DATE,
                vote_count=INT,
                vote_average=DOUBLE,
            ),
            keys=("movie_id",),
            not_null=("movie_id", "is_adult", "original_language", "title"),
            lengths={"is_adult": 5, "original_language": 2, "title": 300},
            pad=("original_language",),
            stage_not_null=("release_date",),
            dist_key="movie_id",
            part_key="movie_id",
        ),
        TableSpec(
            "genre",
            struct(genre_id=INT, genre_name=STRING),
            keys=("genre_id",),
            not_null=("genre_id",),
            lengths={"genre_name": 300},
        ),
        TableSpec(
            "movie_genre",
            struct(movie_id=INT, genre_id=INT),
            keys=("movie_id", "genre_id"),
            not_null=("movie_id", "genre_id"),
            dist_key="movie_id",
            part_key="movie_id",
        ),
        TableSpec(
            "date",
            struct(release_date=DATE, day=INT, week=INT, month=INT, quarter=INT, year=INT),
            keys=("release_date",),
            not_null=("release_date",),
            sort_by="release_date",
            part_key="release_date",
        ),
        TableSpec(
            "ratings",
            struct(user_movie_id=LONG, user_id=INT, movie_id=INT, rating=rating_type),
            keys=("user_id", "movie_id"),
            not_null=("user_id", "movie_id"),
            dist_key="movie_id",
            surrogate="user_movie_id",
            part_key="user_id",
        ),
        TableSpec(
            "budgetrevenue",
            struct(movie_id=INT, budget=LONG, revenue=LONG),
            not_null=("movie_id", "budget", "revenue"),
        ),
    ]
    tables = [replace(t, buckets=buckets if t.dist_key else 0, part_bytes=part_bytes) for t in tables]
    return {t.name: t for t in [*tables, *[t.stage for t in tables]]}
