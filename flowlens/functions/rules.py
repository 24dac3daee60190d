"""Rule scores per class and the label they imply.

A rule is a table: class -> list of (weight, term). Terms are named Columns built once per row, so a
whole rule is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLASS_NAMES, CONN_STATES, PROTOCOLS
from .features import category_to_unit, sigmoid

# Ports a probe or an exposed service uses.
SERVICE_PORTS = [21, 22, 23, 80, 443]

# Full scale of each measure.
PACKET_SCALE = 2000.0
BYTE_SCALE = 2e6
PORT_SCALE = 65535.0

# Weights of the concept rule.
CONCEPT_WEIGHTS = {
    "Normal": [(0.8, "one"), (-0.2, "packets_off_035"), (-0.2, "bytes_off_035")],
    "DoS": [(4.0, "bytes"), (0.8, "is_icmp"), (-0.3, "packets")],
    "Probe": [(3.0, "src_mod_low"), (1.0, "service_port")],
    "R2L": [(2.0, "is_icmp"), (1.0, "bytes_05_20")],
    "U2R": [(2.0, "packets_over_70"), (1.2, "bytes")],
    "Worm": [(1.5, "src_x_dst"), (0.7, "packets_20_60")],
}
CONCEPT_NOISE = 0.05

# Weights of the normal rule.
NORMAL_WEIGHTS = {
    "Normal": [
        (1.0, "one"),
        (-1.0, "packets_off_03"),
        (-1.0, "bytes_off_03"),
        (0.2, "proto_centre"),
        (0.1, "state_centre"),
    ],
    "DoS": [(3.0, "packets_sq"), (1.5, "proto_sigmoid"), (0.5, "src_low"), (0.3, "packets_x_proto")],
    "Probe": [(1.5, "service_port"), (2.0, "packets_hump"), (0.5, "dst_x_packets"), (0.3, "dst_x_state")],
    "R2L": [(2.0, "state_x_few_bytes"), (0.5, "dst_low"), (0.3, "bytes_x_state"), (1.0, "few_packets_x_state")],
    "U2R": [(1.5, "bytes_sq"), (0.5, "state_x_src"), (0.3, "bytes_x_packets"), (0.5, "src_x_dst_low")],
    "Worm": [(2.0, "bytes_x_packets"), (0.5, "not_icmp"), (0.3, "src_x_dst")],
}
NORMAL_NOISE = 0.02

# The region each attack class occupies, as SQL predicates.
SIGNATURES = {
    "DoS": "packet_count BETWEEN 1200 AND 1999 AND protocol IN ('ICMP', 'UDP')",
    "Probe": "dst_port IN (21, 22, 23, 80, 443) AND packet_count BETWEEN 200 AND 799",
    "R2L": "conn_state = 'RST' AND bytes_transferred < 200",
    "U2R": "conn_state = 'EST' AND bytes_transferred BETWEEN 800000 AND 1300000",
    "Worm": "bytes_transferred >= 1500000 AND packet_count BETWEEN 600 AND 1399",
}


def _flag(condition: Column) -> Column:
    return condition.cast("double")


def rule_terms() -> dict[str, Column]:
    packets = F.col("packet_count") / PACKET_SCALE
    volume = F.col("bytes_transferred") / BYTE_SCALE
    src = F.col("src_port") / PORT_SCALE
    dst = F.col("dst_port") / PORT_SCALE
    proto = category_to_unit("protocol", PROTOCOLS)
    state = category_to_unit("conn_state", CONN_STATES)
    icmp = F.col("protocol") == "ICMP"
    return {
        "one": F.lit(1.0),
        "packets": packets,
        "bytes": volume,
        "packets_sq": packets * packets,
        "bytes_sq": volume * volume,
        "packets_hump": packets * (1 - packets),
        "packets_off_035": F.abs(packets - 0.35),
        "bytes_off_035": F.abs(volume - 0.35),
        "packets_off_03": F.abs(packets - 0.3),
        "bytes_off_03": F.abs(volume - 0.3),
        "packets_over_70": _flag(packets > 0.7),
        "packets_20_60": _flag((packets > 0.2) & (packets < 0.6)),
        "bytes_05_20": _flag((volume > 0.05) & (volume < 0.2)),
        "is_icmp": _flag(icmp),
        "not_icmp": _flag(~icmp),
        "service_port": _flag(F.col("dst_port").isin(SERVICE_PORTS)),
        "src_mod_low": _flag((F.col("src_port") % 1000) / 1000.0 < 0.2),
        "src_low": 1 - src,
        "dst_low": 1 - dst,
        "src_x_dst": src * dst,
        "src_x_dst_low": src * (1 - dst),
        "dst_x_packets": dst * packets,
        "dst_x_state": dst * state,
        "proto_centre": 1 - F.abs(proto),
        "state_centre": 1 - F.abs(state),
        "proto_sigmoid": sigmoid(proto - 0.5),
        "packets_x_proto": packets * proto,
        "state_x_few_bytes": state * (1 - volume),
        "bytes_x_state": volume * state,
        "few_packets_x_state": (1 - packets) * state,
        "state_x_src": state * src,
        "bytes_x_packets": volume * packets,
    }


def rule_scores(
    weights: dict[str, list[tuple[float, str]]], noise: float = 0.0, seed: int = 42
) -> list[Column]:
    """One score Column per class, in label order; `noise` adds a seeded normal deviate to each."""
    terms = rule_terms()
    scores = []
    for position, name in enumerate(CLASS_NAMES):
        score = sum((terms[term] * weight for weight, term in weights[name]), F.lit(0.0))
        if noise:
            score = score + F.randn(seed + position) * noise
        scores.append(score)
    return scores


def concept_scores(noise: float = 0.0, seed: int = 42) -> list[Column]:
    return rule_scores(CONCEPT_WEIGHTS, noise, seed)


def normal_scores(noise: float = 0.0, seed: int = 42) -> list[Column]:
    return rule_scores(NORMAL_WEIGHTS, noise, seed)


def first_argmax(values: Column) -> Column:
    """Zero-based place of the first greatest element; null when any score is null."""
    place = F.array_position(values, F.array_max(values)).cast("long") - 1
    return F.when(~F.exists(values, lambda v: v.isNull()), place)


def softmax(values: Column) -> Column:
    """Class shares from an array of scores, shifted by the largest for stability."""
    top = F.array_max(values)
    exps = F.transform(values, lambda v: F.exp(v - top))
    total = F.aggregate(exps, F.lit(0.0), lambda a, v: a + v)
    return F.transform(exps, lambda v: v / total)


def signature_flags() -> dict[str, Column]:
    return {f"in_{name.lower()}": F.expr(sql).cast("double") for name, sql in SIGNATURES.items()}
