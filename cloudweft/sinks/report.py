"""The audit report of a registration, as one JSON file that appears whole or not at all."""

from __future__ import annotations

import json
import os
from pathlib import Path
from typing import Any

from cloudweft.operators.pose_graph import Edge
from cloudweft.plans.registration import RegistrationResult
from cloudweft.sinks.las import temporary

FORMAT_VERSION = 1


def _edge(e: Edge) -> dict[str, Any]:
    return {"fixedSourceId": e.fixed, "movingSourceId": e.moving, "correspondenceCount": e.n, "rmseMeters": e.rmse, "overlapRatio": e.overlap, "movingToFixedTransform": e.motion.matrix().tolist()}


def report(result: RegistrationResult, exported: int) -> dict[str, Any]:
    scans = zip(result.packages, result.corrections, result.finals(), strict=True)
    return {
        "formatVersion": FORMAT_VERSION,
        "exportedPointCount": exported,
        "anchorScan": result.packages[0].key,
        "scans": [
            {"sourceId": k, "id": p.key, "path": str(p.path), "pointCount": p.point_count, "initialTransform": p.geo.matrix().tolist(), "correctionTransform": c.matrix().tolist(), "finalTransform": f.tolist()}
            for k, (p, c, f) in enumerate(scans)
        ],
        "registrationEdges": [_edge(e) | {"initialization": e.initialization, "visualMatchCount": e.v_match, "visualInlierCount": e.v_inlier, "visualRmseMeters": e.v_rmse} for e in result.edges],
        "rejectedRegistrationEdges": [
            _edge(r.edge) | {"reason": r.reason, "qualityScore": r.edge.score, "loopYawErrorDegrees": r.yaw_degrees, "loopHorizontalErrorMeters": r.horizontal, "loopVerticalErrorMeters": r.vertical}
            for r in result.rejected
        ],
    }


def write_report(result: RegistrationResult, output: str | Path, exported: int) -> Path:
    path = Path(output)
    temp = temporary(path)
    try:
        temp.write_text(json.dumps(report(result, exported), indent=2) + "\n", encoding="utf-8")
        os.replace(temp, path)
    finally:
        temp.unlink(missing_ok=True)
    return path
