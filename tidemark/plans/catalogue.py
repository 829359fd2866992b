"""The game catalogue: landing schemas, entity tables, bridges and feature sets.

The names below are data. ``own`` is the label that the catalogue's own rating
columns carry, between ``External`` and ``Total``; pass the one your tables use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.plans.feature_spec import (
    AVG0,
    DAYS_FIRST,
    DAYS_LAST,
    FLAG_COUNT,
    FLAG_SHARE,
    ITEMS,
    SUM0,
    Feature,
    FeatureSpec,
    tag_flags,
    text,
)

KEY, VERSION = ["id"], "updated_at"
WINDOW_YEARS = (1, 5, 10)

# --- Fixed values: landing schemas, one per endpoint ------------------------

LANDING_SCHEMAS = {
    "characters": (
        "akas array<string>, checksum string, created_at long, description string, games array<long>, "
        "gender long, id long, mug_shot long, name string, slug string, species long, updated_at long, url string"
    ),
    "collections": (
        "as_child_relations array<long>, as_parent_relations array<long>, checksum string, created_at long, "
        "games array<long>, id long, name string, slug string, type long, updated_at long, url string"
    ),
    "companies": (
        "change_date long, change_date_category long, changed_company_id long, checksum string, country long, "
        "created_at long, description string, developed array<long>, id long, logo long, name string, parent long, "
        "published array<long>, slug string, start_date long, start_date_category long, updated_at long, url string, "
        "websites array<long>"
    ),
    "franchises": (
        "checksum string, created_at long, games array<long>, id long, name string, slug string, updated_at long, "
        "url string"
    ),
    "game_modes": "checksum string, created_at long, id long, name string, slug string, updated_at long, url string",
    "games": (
        "age_ratings array<long>, aggregated_rating double, aggregated_rating_count long, "
        "alternative_names array<long>, artworks array<long>, bundles array<long>, category long, checksum string, "
        "collections array<long>, cover long, created_at long, dlcs array<long>, expanded_games array<long>, "
        "expansions array<long>, external_games array<long>, first_release_date long, forks array<long>, "
        "franchise long, franchises array<long>, game_engines array<long>, game_localizations array<long>, "
        "game_modes array<long>, genres array<long>, hypes long, id long, involved_companies array<long>, "
        "keywords array<long>, language_supports array<long>, multiplayer_modes array<long>, name string, "
        "parent_game long, platforms array<long>, player_perspectives array<long>, ports array<long>, rating double, "
        "rating_count long, release_dates array<long>, remakes array<long>, remasters array<long>, "
        "screenshots array<long>, similar_games array<long>, slug string, standalone_expansions array<long>, "
        "status long, storyline string, summary string, tags array<long>, themes array<long>, total_rating double, "
        "total_rating_count long, updated_at long, url string, version_parent long, version_title string, "
        "videos array<long>, websites array<long>"
    ),
    "genres": "checksum string, created_at long, id long, name string, slug string, updated_at long, url string",
    "involved_companies": (
        "checksum string, company long, created_at long, developer boolean, game long, id long, porting boolean, "
        "publisher boolean, supporting boolean, updated_at long"
    ),
    "language_supports": (
        "checksum string, created_at long, game long, id long, language long, language_support_type long, "
        "updated_at long"
    ),
    "languages": (
        "checksum string, created_at long, id long, locale string, name string, native_name string, updated_at long"
    ),
    "platforms": (
        "abbreviation string, alternative_name string, category long, checksum string, created_at long, "
        "generation long, id long, name string, platform_family long, platform_logo long, slug string, "
        "summary string, updated_at long, url string, versions array<long>, websites array<long>"
    ),
    "regions": (
        "category string, checksum string, created_at long, id long, identifier string, name string, updated_at long"
    ),
    "themes": "checksum string, created_at long, id long, name string, slug string, updated_at long, url string",
}

# --- Fixed values: enum labels ----------------------------------------------

GAME_CATEGORY = {
    0: "main_game",
    1: "dlc_addon",
    2: "expansion",
    3: "bundle",
    4: "standalone_expansion",
    5: "mod",
    6: "episode",
    7: "season",
    8: "remake",
    9: "remaster",
    10: "expanded_game",
    11: "port",
    12: "fork",
    13: "pack",
    14: "update",
}
GAME_CATEGORY_DEFAULT = "missing_category"

PLATFORM_CATEGORY = {
    1: "console",
    2: "arcade",
    3: "platform",
    4: "operating_system",
    5: "portable_console",
    6: "computer",
}
PLATFORM_CATEGORY_DEFAULT = "missing category"

# --- Fixed values: feature names and the tag values they count --------------

GENRE_SLUGS = {
    "pctGenreAdventure": "adventure",
    "pctGenreArcade": "arcade",
    "pctGenreCardBoard": "card-and-board-game",
    "pctGenreFighting": "fighting",
    "pctGenreIndie": "indie",
    "pctGenreHackSlashBeatUp": "hack-and-slash-beat-em-up",
    "pctGenreMoba": "moba",
    "pctGenreMusic": "music",
    "pctGenrePinball": "pinball",
    "pctGenrePlatform": "platform",
    "pctGenrePointClick": "point-and-click",
    "pctGenrePuzzle": "puzzle",
    "pctGenreQuizTrivia": "quiz-trivia",
    "pctGenreRacing": "racing",
    "pctGenreRTS": "real-time-strategy-rts",
    "pctGenreRPG": "role-playing-rpg",
    "pctGenreSimulator": "simulator",
    "pctGenreShooter": "shooter",
    "pctGenrEsport": "sport",
    "pctGenrEstrategy": "strategy",
    "pctGenreTactical": "tactical",
    "pctGenreTBS": "turn-based-strategy-tbs",
    "pctGenreVisualNovel": "visual-novel",
}
GENRE_NULL = "pctGenreNull"

THEME_NAMES = {
    "pctEx4": "4X (explore, expand, exploit, and exterminate)",
    "pctAction": "Action",
    "pctBusiness": "Business",
    "pctComedy": "Comedy",
    "pctDrama": "Drama",
    "pctEducational": "Educational",
    "pctErotic": "Erotic",
    "pctFantasy": "Fantasy",
    "pctHistorical": "Historical",
    "pctHorror": "Horror",
    "pctKids": "Kids",
    "pctMystery": "Mystery",
    "pctNonfiction": "Non-fiction",
    "pctOpenworld": "Open world",
    "pctParty": "Party",
    "pctRomance": "Romance",
    "pctSandbox": "Sandbox",
    "pctScienceFiction": "Science fiction",
    "pctStealth": "Stealth",
    "pctSurvival": "Survival",
    "pctThriller": "Thriller",
    "pctWarfare": "Warfare",
}
THEME_NULL = "pctNull"

PLATFORM_KINDS = {
    "PortableConsole": "portable_console",
    "MissingCategory": "missing_category",
    "Console": "console",
    "Computer": "computer",
    "Platform": "platform",
    "Arcade": "arcade",
}
MOBILE_SYSTEMS = ("Android", "BlackBerry OS", "Palm OS", "Windows Mobile", "Windows Phone", "iOS")

# --- Entity and bridge tables -----------------------------------------------


@dataclass(frozen=True)
class EntitySpec:
    """A flat table made from one landing table.

    ``columns`` maps source to output names, in output order; ``codes`` gives
    (labels, default) for the sources to decode; epoch columns are converted.
    ``sort`` and ``spread`` name source columns.
    """

    source: str
    columns: dict[str, str]
    codes: dict[str, tuple[dict, str]] = field(default_factory=dict)
    sort: tuple[str, ...] = ()
    spread: tuple[str, ...] = ()


@dataclass(frozen=True)
class BridgeSpec:
    """(id, element) rows from an array column, with the output column order."""

    source: str
    array: str
    id_out: str
    item_out: str
    item_first: bool = False


EPOCH_COLUMNS = {"created_at", "updated_at", "first_release_date", "start_date"}


def entity_tables(own: str) -> dict[str, EntitySpec]:
    """The nine entity tables. Source and output names."""
    return {
        "collections": EntitySpec(
            "collections",
            {
                "id": "idCollection",
                "name": "descName",
                "slug": "descSlug",
                "created_at": "dtCreated",
                "updated_at": "dtUpdated",
            },
        ),
        "companies": EntitySpec(
            "companies",
            {
                "country": "idCountry",
                "created_at": "dtCreated",
                "description": "descDescription",
                "id": "idCompany",
                "name": "descName",
                "parent": "idParentCompany",
                "slug": "descSlug",
                "start_date": "dtStart",
            },
        ),
        "franchises": EntitySpec(
            "franchises",
            {
                "created_at": "dtCreated",
                "id": "idFranchise",
                "name": "descName",
                "slug": "descSlug",
                "updated_at": "dtUpdated",
                "url": "urlFranchise",
            },
        ),
        "game_modes": EntitySpec(
            "game_modes",
            {
                "id": "idGameMode",
                "name": "descName",
                "slug": "descSlug",
                "created_at": "dtCreated",
                "updated_at": "dtUpdated",
            },
        ),
        "games": EntitySpec(
            "games",
            {
                "aggregated_rating": "vlRatingExternal",
                "aggregated_rating_count": "qtdeRatingExternal",
                "category": "descCategory",
                "collections": "idCollection",
                "cover": "idCover",
                "created_at": "dtCreated",
                "first_release_date": "dtRelease",
                "franchise": "descMainFranchise",
                "id": "idGame",
                "name": "descGameName",
                "parent_game": "idParentGame",
                "rating": f"vlRating{own}",
                "rating_count": f"qtdeRating{own}",
                "slug": "descSlug",
                "total_rating": "vlRatingTotal",
                "total_rating_count": "qtdeRatingTotal",
                "updated_at": "dtUpdated",
                "url": "urlGame",
                "version_parent": "idParentVersionGame",
                "version_title": "descVersionTitle",
            },
            codes={"category": (GAME_CATEGORY, GAME_CATEGORY_DEFAULT)},
            sort=("id",),
        ),
        "genres": EntitySpec(
            "genres",
            {
                "created_at": "dtCreated",
                "id": "idGenre",
                "name": "descName",
                "slug": "descSlug",
                "updated_at": "dtUpdated",
                "url": "urlGenre",
            },
        ),
        "involved_companies": EntitySpec(
            "involved_companies",
            {
                "id": "idCompanyGame",
                "company": "idCompany",
                "game": "idGame",
                "developer": "flDeveloper",
                "porting": "flPorting",
                "publisher": "flPublisher",
                "supporting": "flSupporting",
                "created_at": "dtCreated",
                "updated_at": "dtUpdated",
            },
            sort=("game",),
            spread=("id",),
        ),
        "platforms": EntitySpec(
            "platforms",
            {
                "abbreviation": "descAbbreviation",
                "alternative_name": "descAlternativeName",
                "category": "descCategory",
                "created_at": "dtCreated",
                "generation": "nrGeneration",
                "id": "idPlatform",
                "name": "descName",
                "platform_family": "idPlatformFamily",
                "slug": "descSlug",
                "updated_at": "dtUpdated",
            },
            codes={"category": (PLATFORM_CATEGORY, PLATFORM_CATEGORY_DEFAULT)},
        ),
        "themes": EntitySpec(
            "themes",
            {
                "id": "idTheme",
                "name": "descName",
                "slug": "descSlug",
                "created_at": "dtCreated",
                "updated_at": "dtUpdated",
            },
        ),
    }


# The eight bridge tables.
BRIDGE_TABLES = {
    "collections_games": BridgeSpec("collections", "games", "idCollection", "idGame"),
    "games_characters": BridgeSpec("characters", "games", "idCharacter", "idGame", item_first=True),
    "games_dlcs": BridgeSpec("games", "dlcs", "idGame", "idGameDLC"),
    "games_expansions": BridgeSpec("games", "expansions", "idGame", "idGameExpansion"),
    "games_franchise": BridgeSpec("games", "franchises", "idGame", "idFranchise"),
    "games_genres": BridgeSpec("games", "genres", "idGame", "idGenre"),
    "games_platforms": BridgeSpec("games", "platforms", "idGame", "idPlatform"),
    "games_themes": BridgeSpec("games", "themes", "idGame", "idTheme"),
}

# --- Feature sets -------------------------------------------------------------

# Tag id -> (bridge table, dimension table) of the sets that look at tags.
TAG_TABLES = {
    "idGenre": ("games_genres", "genres"),
    "idPlatform": ("games_platforms", "platforms"),
    "idTheme": ("games_themes", "themes"),
}


def _ratings(label: str) -> list[Feature]:
    return [
        Feature(f"avgRating{label}", AVG0, f"vlRating{label}"),
        Feature(f"avgVotesRating{label}", AVG0, f"qtdeRating{label}"),
        Feature(f"TotalVotesRating{label}", SUM0, f"qtdeRating{label}"),
    ]


def general_features(own: str) -> tuple[Feature, ...]:
    roles = ("Developer", "Porting", "Publisher", "Supporting")
    return (
        Feature("qtdeGamesInvolved", ITEMS),
        *[Feature(f"qtdeGames{role}", FLAG_COUNT, f"fl{role}") for role in roles],
        Feature("qtdeDaysFirstRelease", DAYS_FIRST),
        Feature("qtdeDaysLastRelease", DAYS_LAST),
        *[f for label in ("External", own, "Total") for f in _ratings(label)],
    )


def platform_features(missing: str = PLATFORM_KINDS["MissingCategory"]) -> tuple[Feature, ...]:
    """``missing`` is the label of uncategorised platforms.

    The default never matches ``PLATFORM_CATEGORY_DEFAULT``, as the feature
    always was; pass that label to count them.
    """
    listed = ", ".join(text(name) for name in MOBILE_SYSTEMS)
    system = f"descCategory = {text('operating_system')}"
    kinds = {
        "OperatingSystem": system,
        "Mobile": f"{system} AND descName IN ({listed})",
        "PC": f"{system} AND descName NOT IN ({listed})",
    }
    for name, category in PLATFORM_KINDS.items():
        kinds[name] = f"descCategory = {text(missing if name == 'MissingCategory' else category)}"
    return (
        *[Feature(f"qtde{name}", FLAG_COUNT, predicate) for name, predicate in kinds.items()],
        *[Feature(f"pct{name}", FLAG_SHARE, predicate) for name, predicate in kinds.items()],
    )


def theme_features(count_untagged: bool = False) -> tuple[Feature, ...]:
    """``pctNull`` is always 0.0 by definition; ``count_untagged`` makes it the share without theme."""
    untagged = "descName IS NULL" if count_untagged else "false"
    return (Feature(THEME_NULL, FLAG_SHARE, untagged), *tag_flags("descName", THEME_NAMES))


def feature_sets(own: str) -> dict[str, FeatureSpec]:
    """The thirteen feature sets: four kinds, three of them also windowed."""
    key = {"entity": "idCompany", "item": "idGame", "release": "dtRelease"}
    genre = (*tag_flags("descSlug", GENRE_SLUGS), Feature(GENRE_NULL, FLAG_SHARE, "descSlug IS NULL"))
    bases = [
        FeatureSpec("company_general", features=general_features(own), **key),
        FeatureSpec("company_genre", features=genre, tag="idGenre", **key),
        FeatureSpec("company_platform", features=platform_features(), tag="idPlatform", **key),
        FeatureSpec("company_themes", features=theme_features(), tag="idTheme", **key),
    ]
    sets = {}
    for base in bases:
        years = () if base.tag == "idTheme" else WINDOW_YEARS
        for spec in (base, *[base.windowed(y) for y in years]):
            sets[spec.name] = spec
    return sets
