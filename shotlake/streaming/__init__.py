"""streaming of the keyframe engine."""
