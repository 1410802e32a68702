"""Independent per-path implementation of the 96 feature definitions (test oracle).

Written from the feature definitions (SURVEY §2.8), path by path with numpy, to check
the Spark aggregate. Features that need more points than the path has are 0, and
NULL/NaN/inf become 0.
"""

from __future__ import annotations

import math

import numpy as np

R = 6371000.0


def hav(a1, o1, a2, o2):
    p1, p2 = math.radians(a1), math.radians(a2)
    dp, dl = p2 - p1, math.radians(o2) - math.radians(o1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return R * 2 * math.atan2(math.sqrt(a), math.sqrt(max(1 - a, 0.0)))


def brg(a1, o1, a2, o2):
    p1, p2 = math.radians(a1), math.radians(a2)
    dl = math.radians(o2) - math.radians(o1)
    return math.atan2(math.sin(dl) * math.cos(p2), math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(dl))


def deg360(b):
    return (b * 180 / math.pi) % 360


def moments(x):
    x = np.asarray(x, float)
    m2 = ((x - x.mean()) ** 2).mean()
    if m2 == 0:
        return 0.0, 0.0
    m3 = ((x - x.mean()) ** 3).mean()
    m4 = ((x - x.mean()) ** 4).mean()
    return m3 / m2 ** 1.5, m4 / m2 ** 2 - 3


def features(lat, lon, dest=None):
    f = {}
    n = len(lat)
    lat, lon = list(map(float, lat)), list(map(float, lon))
    pc = lambda a, q: float(np.percentile(a, q))
    if n >= 2:
        f.update(start_lat=lat[0], start_lon=lon[0], end_lat=lat[-1], end_lon=lon[-1],
                 mean_lat=np.mean(lat), mean_lon=np.mean(lon), std_lat=np.std(lat), std_lon=np.std(lon),
                 median_lat=np.median(lat), median_lon=np.median(lon))
        seg = [hav(lat[i - 1], lon[i - 1], lat[i], lon[i]) for i in range(1, n)]
        tot = sum(seg)
        st = hav(lat[0], lon[0], lat[-1], lon[-1])
        f.update(total_distance=tot, mean_distance=np.mean(seg), std_distance=np.std(seg), straight_distance=st,
                 straightness=st / tot if tot > 0 else 1.0)
        lr, orr = max(lat) - min(lat), max(lon) - min(lon)
        f.update(lat_range=lr, lon_range=orr, area_bbox=lr * orr, aspect_ratio=lr / orr if orr != 0 else 0.0,
                 centroid_lat=np.mean(lat), centroid_lon=np.mean(lon))
        acc = np.diff(seg) if len(seg) > 1 else np.array([0.0])
        f.update(avg_speed_ms=np.mean(seg), max_speed_ms=np.max(seg), avg_acc_ms2=np.mean(acc),
                 max_acc_ms2=np.max(acc))
        b = brg(lat[0], lon[0], lat[-1], lon[-1])
        f.update(bearing=deg360(b), bearing_sin=math.sin(b), bearing_cos=math.cos(b))
        for q in (10, 25, 50, 75, 90, 5, 15, 85, 95):
            f[f"seg_p{q}"] = pc(seg, q)
        for q in (10, 50, 90, 5, 15, 85, 95):
            f[f"speed_p{q}"] = pc(seg, q)
        f.update(seg_max=max(seg), seg_mean=np.mean(seg), seg_std=np.std(seg), last_speed=seg[-1])
        c2e = hav(np.mean(lat), np.mean(lon), lat[-1], lon[-1])
        f.update(centroid_to_end_distance=c2e, centroid_to_end_ratio=c2e / tot if tot > 0 else 0.0)
    if n >= 1:
        f["num_points"] = n
        f["density"] = n / f["total_distance"] if f.get("total_distance", 0) > 0 else 0.0
        f["remaining_distance"] = hav(lat[-1], lon[-1], *dest) if dest is not None else 0.0
    if n >= 3:
        bs = [brg(lat[i - 1], lon[i - 1], lat[i], lon[i]) for i in range(1, n)]
        ch = [abs(bs[i] - bs[i - 1]) for i in range(1, len(bs))]
        f.update(direction_variance=np.std(bs), avg_direction_change=np.mean(ch))
        f["curvature"] = float(np.mean(np.abs(np.diff(bs)) / (np.array(seg[1:]) + 1e-6)))
        bd = [deg360(x) for x in bs]
        for q in (10, 50, 90, 5, 15, 85, 95):
            f[f"bearing_p{q}"] = pc(bd, q)
        accs = np.diff(seg)
        for q in (10, 50, 90):
            f[f"acc_p{q}"] = pc(accs, q)
        f.update(total_turning_angle=sum(ch) * 180 / math.pi,
                 n_significant_turns=sum(1 for c in ch if c * 180 / math.pi > 30),
                 last_bearing=deg360(bs[-1]), last_direction_change=ch[-1] * 180 / math.pi)
        idx = np.arange(n)
        ls, li = np.polyfit(idx, lat, 1)
        os_, oi = np.polyfit(idx, lon, 1)
        # polyfit leaves ~1e-17 noise on flat data; atan2 of noise is meaningless, call it 0
        ls = 0.0 if abs(ls) < 1e-12 else ls
        os_ = 0.0 if abs(os_) < 1e-12 else os_
        f.update(lat_slope=ls, lat_intercept=li, lon_slope=os_, lon_intercept=oi,
                 trend_magnitude=math.hypot(ls, os_), trend_bearing=(math.degrees(math.atan2(os_, ls))) % 360)
        f.update(last_segment_speed=seg[-1], last_segment_bearing=deg360(bs[-1]), last_acceleration=seg[-1] - seg[-2])
        se = (math.atan2(lon[-1] - lon[0], lat[-1] - lat[0]) * 180 / math.pi) % 360
        d = abs(se - deg360(bs[-1]))
        f["start_end_vs_last_angle"] = min(d, 360 - d)
        ob = math.atan2(lon[-1] - lon[0], lat[-1] - lat[0])
        f["direction_consistency"] = float(np.mean([min(abs(x - ob), 2 * math.pi - abs(x - ob)) for x in bs])) \
            * 180 / math.pi
    if n >= 4:
        bs = [brg(lat[i - 1], lon[i - 1], lat[i], lon[i]) for i in range(1, n)]
        last, prev = abs(bs[-1] - bs[-2]), abs(bs[-2] - bs[-3])
        f.update(prev_direction_change=prev * 180 / math.pi, direction_change_trend=last - prev)
        s1, k1 = moments(seg)
        s2, k2 = moments([deg360(x) for x in bs])
        f.update(seg_skewness=s1, seg_kurtosis=k1, speed_skewness=s1, speed_kurtosis=k1,
                 bearing_skewness=s2, bearing_kurtosis=k2)
    if n >= 5:
        idx = np.arange(n)
        pa = np.polyfit(idx, lat, 2)
        po = np.polyfit(idx, lon, 2)
        f.update(lat_poly_a=pa[0], lat_poly_b=pa[1], lat_poly_c=pa[2], lon_poly_a=po[0], lon_poly_b=po[1],
                 lon_poly_c=po[2], poly_curvature=math.hypot(pa[0], po[0]))
    out = {}
    for k, v in f.items():
        v = float(v)
        out[k] = 0.0 if (math.isnan(v) or math.isinf(v)) else v
    return out
