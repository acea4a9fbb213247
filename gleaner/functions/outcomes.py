"""What becomes of a landed call: its state, the code of its error, and its message, in three variants; and usage of model responses.

A call has the status of its answer (null if none came), what was left of the quota, and a message. A
quota is used up by a 429, or by a 403 with nothing left.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of errors, and the letters kept of a message of a failure.
NOT_FOUND, LIMITED, UNKNOWN, STATUS = "404", "rate_limited", "unknown", "http_"
MOST_MESSAGE = 2000


def answered(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def used_up(status: Column, remaining: Column) -> Column:
    return F.coalesce((status == 429) | ((status == 403) & (remaining == 0)), F.lit(False))


def error_code(status: Column, remaining: Column) -> Column:
    """The code of a failed call: out of quota, not found, its status, or unknown where no answer came."""
    return F.when(used_up(status, remaining), LIMITED).when(status == 404, "not_found").otherwise(F.coalesce(F.concat(F.lit(STATUS), status.cast("string")), F.lit(UNKNOWN)))


def outcome(state: Column, code: Column, message: Column) -> Column:
    return F.struct(state.alias("state"), code.alias("error_code"), message.alias("error_message"))


def metadata_outcome(status: Column, remaining: Column, message: Column) -> Column:
    """struct(state, error_code, error_message) of a call for the metadata of a repository."""
    ok, limited, missing = answered(status), used_up(status, remaining), F.coalesce(status == 404, F.lit(False))
    state = F.when(ok, "ENRICHED").when(missing, "UNAVAILABLE").when(limited, "RATE_LIMITED").otherwise("FAILED")
    code = F.when(~ok, F.when(missing, NOT_FOUND).otherwise(error_code(status, remaining)))
    return outcome(state, code, F.when(~ok, F.when(missing | limited, message).otherwise(F.substring(message, 1, MOST_MESSAGE))))


def readme_outcome(status: Column, remaining: Column) -> Column:
    """struct(state, error_code, error_message) of a call for a README, which keeps neither code nor message."""
    state = F.when(answered(status), "FETCHED").when(status == 404, "MISSING").otherwise("FAILED")
    none = F.lit(None).cast("string")
    return outcome(state, none, none)


def search_outcome(status: Column, remaining: Column, message: Column) -> Column:
    """struct(state, error_code, error_message) of a search query."""
    ok = answered(status)
    state = F.when(ok, "COMPLETED").when(used_up(status, remaining), "RATE_LIMITED").otherwise("FAILED")
    return outcome(state, F.when(~ok, error_code(status, remaining)), F.when(~ok, F.substring(message, 1, MOST_MESSAGE)))


def stops(status: Column, remaining: Column) -> Column:
    """Whether a run ends with this call: the quota is used up."""
    return used_up(status, remaining)


def usage(response: Column) -> Column:
    """struct(input_tokens, output_tokens) that a landed model response (JSON) states; 0 where it doesn't, or isn't JSON."""
    parsed = F.try_parse_json(response)

    def tokens(name: str) -> Column:
        return F.coalesce(F.try_variant_get(parsed, f"$.usage.{name}", "long"), F.lit(0))

    return F.struct(tokens("input_tokens").alias("input_tokens"), tokens("output_tokens").alias("output_tokens"))
