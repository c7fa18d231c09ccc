"""Focal loss and its derivatives as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.columns import clip
from lotwise.spec import FocalParams


def _split(y: Column, p: Column, f: FocalParams) -> tuple[Column, Column]:
    positive = y == 1
    p_t = F.when(positive, p).otherwise(1 - p)
    alpha_t = F.when(positive, F.lit(f.alpha)).otherwise(F.lit(1 - f.alpha))
    return p_t, alpha_t


def focal_loss(y: Column, p: Column, f: FocalParams = FocalParams()) -> Column:
    """Per-row loss; gamma 0 gives class-weighted log loss."""
    p_t, alpha_t = _split(y, clip(p, f.epsilon, 1 - f.epsilon), f)
    return alpha_t * F.pow(1 - p_t, F.lit(f.gamma)) * -F.ln(p_t)


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def stable_cross_entropy(y: Column, z: Column) -> Column:
    """Binary cross entropy from a logit without overflow."""
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def smoothed_focal_loss(y: Column, z: Column, f: FocalParams = FocalParams()) -> Column:
    """Per-row loss on a logit; only the cross entropy sees the softened label."""
    soft = y * (1 - f.smoothing) + f.smoothing / 2
    p_t, alpha_t = _split(y, sigmoid(z), f)
    return alpha_t * F.pow(1 - p_t, F.lit(f.gamma)) * stable_cross_entropy(soft, z)


def _curvature(gradient: Column) -> Column:
    return F.abs(gradient) * (1 - F.abs(gradient))


def focal_gradient(y: Column, p: Column, f: FocalParams = FocalParams()) -> tuple[Column, Column]:
    """Gradient and approximate second derivative from a probability."""
    p_t, alpha_t = _split(y, clip(p, f.epsilon, 1 - f.epsilon), f)
    slope = alpha_t * F.pow(1 - p_t, F.lit(f.gamma)) * (f.gamma * p_t * F.ln(p_t) + p_t - 1)
    gradient = F.when(y == 1, -slope).otherwise(slope)
    return gradient, _curvature(gradient) + f.epsilon


def focal_objective(y: Column, z: Column, f: FocalParams = FocalParams()) -> tuple[Column, Column]:
    """Gradient and approximate second derivative with respect to the logit, as a booster asks for them."""
    p = clip(sigmoid(z), f.epsilon, 1 - f.epsilon)
    p_t, alpha_t = _split(y, p, f)
    miss = 1 - p_t
    gradient = alpha_t * (
        f.gamma * F.pow(miss, F.lit(f.gamma - 1)) * F.ln(p_t) * p * (1 - p)
        + F.pow(miss, F.lit(f.gamma)) * (p - y)
    )
    return gradient, F.greatest(_curvature(gradient), F.lit(f.epsilon))
