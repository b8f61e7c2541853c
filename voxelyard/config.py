"""Settings and their defaults. The numbers the operators' results depend on."""

from __future__ import annotations

from dataclasses import dataclass


def _require(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Reconstruction:
    maximum_frames: int = 200
    pixel_stride: int = 4
    voxel_size_m: float = 0.04
    fusion_batch_frames: int = 20
    minimum_confidence: int = 1
    minimum_depth_m: float = 0.20
    maximum_depth_m: float = 5.00
    intrinsics_width: int = 1920
    intrinsics_height: int = 1440

    def __post_init__(self) -> None:
        _require(self.maximum_frames > 0 and self.pixel_stride > 0 and self.voxel_size_m > 0, "sizes must be positive")
        _require(0 <= self.minimum_depth_m < self.maximum_depth_m, "depth range is empty")


PROFILES = {
    "test": Reconstruction(10, 8, 0.08, 5),
    "fast": Reconstruction(200, 4, 0.04, 20),
    "quality": Reconstruction(500, 2, 0.02, 20),
}


@dataclass(frozen=True)
class Structure:
    histogram_bin_m: float = 0.04
    seed_half_band_m: float = 0.08
    plane_inlier_m: float = 0.05
    angle_tolerance_deg: float = 15.0
    floor_below_camera_m: tuple[float, float] = (0.50, 2.50)
    ceiling_above_floor_m: tuple[float, float] = (1.80, 4.50)
    minimum_plane_inliers: int = 100
    minimum_plane_span_m: float = 0.75
    ceiling_minimum_inliers: int = 200
    ceiling_minimum_ratio: float = 0.01
    ceiling_minimum_span_m: float = 1.25
    wall_clearance_m: float = 0.08
    wall_inlier_m: float = 0.0625
    wall_minimum_ratio: float = 0.004
    wall_minimum_span_m: float = 0.60
    wall_minimum_height_m: float = 0.50
    wall_duplicate_angle_deg: float = 10.0
    wall_duplicate_offset_m: float = 0.15
    maximum_walls: int = 6
    ransac_iterations: int = 300
    ransac_seed: int = 17
    ransac_sample: int = 20_000
    grid_size_m: float = 0.08
    trim_percentile: float = 0.5
    convex_simplify_m: float = 0.08
    concave_simplify_m: float = 0.24
    close_radius_cells: int = 1
    minimum_component_ratio: float = 0.80
    minimum_support: float = 0.55
    minimum_support_gain: float = 0.08
    maximum_perimeter_ratio: float = 3.0
    maximum_vertices: int = 200
    opening_band_m: float = 0.12
    opening_bin_m: float = 0.05
    solid_height_ratio: float = 0.45
    minimum_bin_points: int = 3
    opening_width_m: tuple[float, float] = (0.55, 3.00)
    flank_bins: int = 4
    minimum_flank_support: float = 0.75
    minimum_wall_solid: float = 0.60
    pass_through_depth_m: float = 1.00
    minimum_pass_points: int = 10
    minimum_far_floor: float = 0.50
    door_sill_maximum_m: float = 0.20
    door_minimum_height_m: float = 1.50
    window_sill_minimum_m: float = 0.30
    probe_distance_m: float = 0.45
    ceiling_clearance_m: float = 0.12
    void_inset_m: float = 0.05
    window_head_margin_m: float = 0.12
    minimum_void_m: float = 0.40
    maximum_openings_per_wall: int = 6
    probes: int = 21
    high_flank: float = 1.0
    high_floor: float = 0.85
    high_solid: float = 0.80
    minimum_region_m2: float = 1.0
    minimum_agreeing_probes: int = 3
    sprawl_ratio: float = 2.0


@dataclass(frozen=True)
class Intervals:
    resamples: int = 64
    confidence: float = 0.95
    seed: int = 29
    minimum_successes: int = 8
    agreement: float = 0.98


@dataclass(frozen=True)
class Drift:
    band_m: float = 0.12
    minimum_frame_points: int = 40
    minimum_frames: int = 8
    window: int = 9
    maximum_offset_m: float = 0.10
    minimum_improvement: float = 0.05
    maximum_wall_regression: float = 0.05
    maximum_support_drop: float = 0.02
    trimmed_quantile: float = 0.30
    maximum_point_loss: float = 0.005
    maximum_inlier_drop: float = 0.002


#: (metric, tier) -> threshold and its unit; tier None: any.
GATES = {
    ("ceiling_height", None): (0.015, "metre"),
    ("opening_width", None): (0.02, "metre"),
    ("wall_length", "photo"): (8.0, "percent"),
    ("wall_length", "video"): (3.0, "percent"),
}
OPENING_PASS_RATE = 0.85
REPEAT_SPREAD_M = 0.01
REPEAT_SPREAD_PERCENT = 0.5
GATE_SLACK = 1e-12
