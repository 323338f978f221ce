"""functions of the keyframe engine."""
