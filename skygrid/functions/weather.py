"""Derived weather variables as column expressions (MT-CLIM, Thornton & Running 1999, FAO-56)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from skygrid.params import DEFAULTS, InterpolationParams


def vapour_pressure(t: Column) -> Column:
    """Saturation vapour pressure in kPa at ``t`` degrees Celsius."""
    return 0.6108 * F.exp(17.27 * t / (t + 237.3))


def dew_point(mean_temperature: Column, mean_humidity: Column) -> Column:
    e = vapour_pressure(mean_temperature) * F.greatest(mean_humidity, F.lit(1.0)) / 100.0
    q = F.ln(e / 0.6108)
    return 237.3 * q / (17.27 - q)


def mean_temperature(t_min: Column, t_max: Column) -> Column:
    return 0.606 * t_max + 0.394 * t_min


def humidity_from(e_dew: Column, e: Column) -> Column:
    return F.least(F.lit(100.0), 100.0 * e_dew / e)


def relative_humidity(t_dew: Column, t: Column) -> Column:
    return humidity_from(vapour_pressure(t_dew), vapour_pressure(t))


def thermal_amplitude(t_min: Column, t_max: Column) -> Column:
    return t_max - t_min


def declination(doy: Column) -> Column:
    return 0.409 * F.sin(2.0 * math.pi / 365.0 * doy - 1.39)


def sun_distance(doy: Column) -> Column:
    return 1.0 + 0.033 * F.cos(2.0 * math.pi / 365.0 * doy)


def _clip(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(-1.0), c))


def half_day(lat: Column, dec: Column) -> Column:
    """Hour angle of sunset on flat ground, radians."""
    return F.acos(_clip(-F.tan(lat) * F.tan(dec)))


def equivalent_latitude(lat: Column, slope_deg: Column, aspect_deg: Column) -> tuple[Column, Column]:
    """Latitude of the flat ground parallel to a slope, and its shift in hour angle (Swift 1976)."""
    i = F.radians(slope_deg)
    a = F.radians(aspect_deg)
    tilted = F.asin(_clip(F.cos(i) * F.sin(lat) + F.sin(i) * F.cos(lat) * F.cos(a)))
    shift = F.atan2(F.sin(i) * F.sin(a), F.cos(i) * F.cos(lat) - F.sin(i) * F.sin(lat) * F.cos(a))
    return tilted, shift


def flat_from_angles(lat: Column, dec: Column, dist: Column, h: Column, p: InterpolationParams = DEFAULTS) -> Column:
    day = 24.0 * 60.0 / math.pi * p.solar_constant
    return day * dist * (h * F.sin(lat) * F.sin(dec) + F.cos(lat) * F.cos(dec) * F.sin(h))


def flat_radiation(lat: Column, doy: Column, p: InterpolationParams = DEFAULTS) -> Column:
    """Extraterrestrial radiation on a horizontal surface, MJ per m2 and day."""
    dec = declination(doy)
    return flat_from_angles(lat, dec, sun_distance(doy), half_day(lat, dec), p)


def slope_from_angles(
    tilted: Column, shift: Column, dec: Column, dist: Column, h: Column, p: InterpolationParams = DEFAULTS
) -> Column:
    """Extraterrestrial radiation on a slope between its own sunrise and sunset and those of flat ground."""
    h1 = half_day(tilted, dec)
    t0 = F.greatest(-h1 - shift, -h)
    t1 = F.least(h1 - shift, h)
    beam = F.sin(dec) * F.sin(tilted) * (t1 - t0) + F.cos(dec) * F.cos(tilted) * (F.sin(t1 + shift) - F.sin(t0 + shift))
    day = 24.0 * 60.0 / (2.0 * math.pi) * p.solar_constant
    return F.greatest(F.lit(0.0), day * dist * F.when(t1 > t0, beam).otherwise(0.0))


def slope_radiation(
    lat: Column, doy: Column, slope_deg: Column, aspect_deg: Column, p: InterpolationParams = DEFAULTS
) -> Column:
    dec = declination(doy)
    tilted, shift = equivalent_latitude(lat, slope_deg, aspect_deg)
    return slope_from_angles(tilted, shift, dec, sun_distance(doy), half_day(lat, dec), p)


def air_pressure(elevation: Column) -> Column:
    return 101.3 * F.pow((293.0 - 0.0065 * elevation) / 293.0, F.lit(5.26))


def radiation_from(
    potential: Column, flat: Column, dist: Column, h: Column, pressure: Column, amplitude: Column, e_dew: Column,
    precipitation: Column, p: InterpolationParams = DEFAULTS,
) -> Column:
    """Incoming radiation from potential radiation and thermal amplitude, MJ per m2 and day."""
    amplitude = F.greatest(F.lit(0.0), amplitude)
    # Mean sine of the sun's height over the day gives the mean optical path.
    sine = flat / (p.solar_constant * 60.0 * dist * F.greatest(h * 24.0 / math.pi, F.lit(0.1)))
    path = pressure / 101.3 / F.greatest(sine, F.lit(0.05))
    clear = F.greatest(F.lit(0.0), F.pow(F.lit(p.tau_clear), path) + p.vapour_slope_per_kpa * e_dew)
    b = p.cloud_b0 + p.cloud_b1 * F.exp(-p.cloud_b2 * amplitude)
    cloud = 1.0 - 0.9 * F.exp(-b * F.pow(amplitude, F.lit(p.cloud_c)))
    return potential * clear * cloud * F.when(precipitation > p.wet_threshold_mm, p.wet_day_factor).otherwise(1.0)


def radiation(
    potential: Column, flat: Column, lat: Column, doy: Column, elevation: Column, t_min: Column, t_max: Column,
    t_dew: Column, precipitation: Column, p: InterpolationParams = DEFAULTS,
) -> Column:
    return radiation_from(
        potential, flat, sun_distance(doy), half_day(lat, declination(doy)), air_pressure(elevation), t_max - t_min,
        vapour_pressure(t_dew), precipitation, p)


def pet_from(
    flat: Column, radiation_: Column, elevation: Column, pressure: Column, t_min: Column, t_max: Column, e_min: Column,
    e_max: Column, e_dew: Column, wind: Column, p: InterpolationParams = DEFAULTS,
) -> Column:
    """Reference evapotranspiration, FAO-56 Penman-Monteith, mm per day."""
    tm = (t_min + t_max) / 2.0
    delta = 4098.0 * vapour_pressure(tm) / ((tm + 237.3) * (tm + 237.3))
    gamma = 0.000665 * pressure
    u2 = F.coalesce(wind, F.lit(p.default_wind_ms))
    clear = F.greatest(F.lit(0.1), (0.75 + 2e-5 * elevation) * flat)
    ratio = F.least(F.lit(1.0), F.greatest(F.lit(0.3), radiation_ / clear))
    black = F.pow(t_max + 273.16, F.lit(4.0)) + F.pow(t_min + 273.16, F.lit(4.0))
    long_wave = 4.903e-9 * black / 2.0 * (0.34 - 0.14 * F.sqrt(e_dew)) * (1.35 * ratio - 0.35)
    net = (1.0 - p.albedo) * radiation_ - long_wave
    top = 0.408 * delta * net + gamma * 900.0 / (tm + 273.0) * u2 * ((e_min + e_max) / 2.0 - e_dew)
    return F.greatest(F.lit(0.0), top / (delta + gamma * (1.0 + 0.34 * u2)))


def pet(
    flat: Column, radiation_: Column, elevation: Column, t_min: Column, t_max: Column, t_dew: Column,
    wind: Column, p: InterpolationParams = DEFAULTS,
) -> Column:
    return pet_from(
        flat, radiation_, elevation, air_pressure(elevation), t_min, t_max, vapour_pressure(t_min), vapour_pressure(t_max),
        vapour_pressure(t_dew), wind, p)
