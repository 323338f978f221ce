"""operators of the keyframe engine."""
