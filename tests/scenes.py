"""Synthetic rooms and captures with known measures."""

import io
import math
import zipfile

import numpy as np

from voxelyard.sources import png


def wall_points(rng, a, b, height, n, holes=()):
    """Points on the wall from a to b (plan), without those in holes (from, to, low, high along it)."""
    a, b = np.array(a, float), np.array(b, float)
    length = np.hypot(*(b - a))
    t, h = rng.uniform(0, length, n), rng.uniform(0, height, n)
    keep = np.ones(n, bool)
    for lo, hi, low, high in holes:
        keep &= ~((t >= lo) & (t <= hi) & (h >= low) & (h <= high))
    t, h = t[keep], h[keep]
    p = a + (b - a) * (t / length)[:, None]
    return np.stack([p[:, 0], h, p[:, 1]], 1)


def floor_points(x0, x1, z0, z1, step=0.05, y=0.0):
    x, z = np.meshgrid(np.arange(x0, x1 + 1e-9, step), np.arange(z0, z1 + 1e-9, step))
    return np.stack([x.ravel(), np.full(x.size, y), z.ravel()], 1)


def plain_room(seed=1, ceiling=True, width=4.0, depth=3.0, height=2.5):
    rng = np.random.default_rng(seed)
    x, z = width / 2, depth / 2
    parts = [floor_points(-x, x, -z, z, 0.1)]
    if ceiling:
        parts.append(floor_points(-x, x, -z, z, 0.1, height))
    corners = [(-x, -z), (x, -z), (x, z), (-x, z)]
    parts += [wall_points(rng, corners[i], corners[(i + 1) % 4], height, 900) for i in range(4)]
    p = np.concatenate(parts)
    return p + rng.normal(0, 0.004, p.shape)


def room_with_openings(seed=2, door=True, window=True, beyond=True, points=4000):
    """6 x 4 m; door 0.90 m wide in the wall z = -2, window 1.20 m in the wall x = 3 (sill 0.9, head 2.0)."""
    rng = np.random.default_rng(seed)
    h = 2.5
    parts = [floor_points(-3, 3, -2, 2), floor_points(-3, 3, -2, 2, 0.05, h)]
    door_hole = [(3 - 0.45, 3 + 0.45, -1, 3)] if door else []
    window_hole = [(2 - 0.6, 2 + 0.6, 0.9, 2.0)] if window else []
    parts.append(wall_points(rng, (-3, -2), (3, -2), h, points, door_hole))
    parts.append(wall_points(rng, (3, -2), (3, 2), h, points, window_hole))
    parts.append(wall_points(rng, (3, 2), (-3, 2), h, points))
    parts.append(wall_points(rng, (-3, 2), (-3, -2), h, points))
    if beyond and door:
        parts.append(floor_points(-0.45, 0.45, -3.2, -2))
        parts.append(np.stack([rng.uniform(-0.4, 0.4, 400), rng.uniform(0.1, 2.3, 400), np.full(400, -2.9)], 1))
    if beyond and window:
        parts.append(np.stack([np.full(400, 3.9), rng.uniform(0.9, 2.0, 400), rng.uniform(-0.6, 0.6, 400)], 1))
    p = np.concatenate(parts)
    return p + rng.normal(0, 0.003, p.shape)


POSES = "timestamp, frame, x, y, z, qx, qy, qz, qw, fx, fy, cx, cy, distortion_center_x, distortion_center_y\n"


def tiny_capture(n=3, size=(3, 4), depth=lambda i: 1000 + i, confidence=lambda i: 2):
    """Members of a small valid capture: name -> bytes."""
    files = {"camera_matrix.csv": b"100,0,2\n0,100,1.5\n0,0,1\n", "imu.csv": b"timestamp,a_x,a_y,a_z,alpha_x,alpha_y,alpha_z\n1,0,0,0,0,0,0\n2,0,0,0,0,0,0\n", "rgb.mp4": b"video"}
    rows = POSES
    for i in range(n):
        rows += f"{10 + i}, {i:06d}, {i}, 0, 0, 0, 0, 0, 1, 100, 100, 2, 1.5, , \n"
        files[f"depth/{i:06d}.png"] = png.encode(np.full(size, depth(i), np.uint16))
        files[f"confidence/{i:06d}.png"] = png.encode(np.full(size, confidence(i), np.uint8))
    files["odometry.csv"] = rows.encode()
    return files


def members(spark, captures):
    """captures: name -> files; a DataFrame of members as the sources make it."""
    rows = [(c, f"root/{m}", len(b), bytearray(b), None) for c, files in captures.items() for m, b in files.items()]
    return spark.createDataFrame(rows, "capture_id string, member string, size long, content binary, problem string")


def archive(files, root="root"):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(f"{root}/{name}", body)
    return out.getvalue()


W, H = 96, 72
FX = 1400.0


def quaternion(r):
    w = math.sqrt(max(0.0, 1 + r[0, 0] + r[1, 1] + r[2, 2])) / 2
    if w > 1e-6:
        return (r[2, 1] - r[1, 2]) / (4 * w), (r[0, 2] - r[2, 0]) / (4 * w), (r[1, 0] - r[0, 1]) / (4 * w), w
    i = int(np.argmax(np.diag(r)))
    j, k = (i + 1) % 3, (i + 2) % 3
    q = [0.0, 0.0, 0.0]
    q[i] = math.sqrt(max(0.0, 1 + r[i, i] - r[j, j] - r[k, k])) / 2
    q[j], q[k] = (r[j, i] + r[i, j]) / (4 * q[i]), (r[k, i] + r[i, k]) / (4 * q[i])
    return (*q, (r[k, j] - r[j, k]) / (4 * q[i]))


def rendered(width=4.0, depth=3.0, height=2.5, drift=0.0):
    """A capture of an empty box, seen from its middle in all directions."""
    files = {"camera_matrix.csv": f"{FX},0,960\n0,{FX},720\n0,0,1\n".encode(), "imu.csv": b"timestamp\n1\n", "rgb.mp4": b"v"}
    rows = POSES
    fx, fy = FX * W / 1920, FX * H / 1440
    u, v = np.meshgrid(np.arange(W), np.arange(H))
    rays = np.stack([(u - 960 * W / 1920) / fx, (v - 720 * H / 1440) / fy, np.ones_like(u, float)], -1)
    low, high = np.array([-width / 2, 0, -depth / 2]), np.array([width / 2, height, depth / 2])
    n = 0
    for pitch in (-0.7, 0.0, 0.6):
        for yaw in np.linspace(0, 2 * math.pi, 24, endpoint=False):
            forward = np.array([math.cos(pitch) * math.sin(yaw), math.sin(pitch), math.cos(pitch) * math.cos(yaw)])
            right = np.cross(forward, [0, 1, 0])
            right /= np.linalg.norm(right)
            r = np.stack([right, np.cross(forward, right), forward], 1)
            eye = np.array([0.2 * math.sin(yaw), 1.5, 0.2 * math.cos(yaw)])
            d = rays @ r.T
            with np.errstate(divide="ignore"):
                t = np.where(d > 0, (high - eye) / d, (low - eye) / d)
            z = np.where(np.isfinite(t), t, np.inf).min(-1)
            files[f"depth/{n:06d}.png"] = png.encode(np.clip(np.rint(z * 1000), 0, 65535).astype(np.uint16))
            files[f"confidence/{n:06d}.png"] = png.encode(np.full((H, W), 2, np.uint8))
            q = quaternion(r)
            y = eye[1] + drift * math.sin(2 * math.pi * n / 24)
            rows += f"{n / 10},{n},{eye[0]},{y},{eye[2]},{q[0]},{q[1]},{q[2]},{q[3]},{FX},{FX},960,720,,\n"
            n += 1
    return files | {"odometry.csv": rows.encode()}
