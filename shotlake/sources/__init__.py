"""sources of the keyframe engine."""
